"""Each operator against a plain brute-force version, over whole small tables."""
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from obslake.llm import (linking, mixing, near_dedup, packing, passages, pieces, quality, queries, secret_scans, sketch, spans, toxicity, urls,
                         vectors)
from obslake.llm.common import table

SF, SF_MORE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
WORD = re.compile("[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, node string, x int, spans int, size int, shard int"
HARD = [(1, None), (2, ""), (3, " \n\t "), (4, "tiny"), (5, "lorem " * 30_000), (6, "one two three four five six"),
        (6, "one two three four five six"), (7, "ONE two three four five six"), (None, "one two three four five six"),
        (8, "token=abcdef token: abc\npassword = 'x1y2z3w4'"), (9, "naïve ☃ 𝒳 line\nline\nline\n\n" + "é" * 3000)]


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents").cache()


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def hard(spark):
    """Nulls, empty and very long texts, repeated rows and columns named like the operators' own."""
    rows = [(i, t, None, None if k % 3 == 0 else "s", None, "z", "z", 1, 1, 1, 1) for k, (i, t) in enumerate(HARD)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text):
    w = WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    k = min(5, len(w))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else frozenset()


def linked(sets):
    """Smallest key reachable over similar sets, by all pairs."""
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k
    keys = sorted(sets)
    for n, a in enumerate(keys):
        for b in keys[:n]:
            both = len(sets[a] & sets[b])
            if both and 4 * both >= 3 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: find(k) for k in keys}


def test_near_duplicates(docs, texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    got = near_dedup.near_duplicates(docs).collect()
    assert {r.doc_id: r.component_id for r in got} == linked(sets)
    assert all(r.n_shingles == len(sets[r.doc_id]) and r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_hard(hard, none):
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(hard).collect())
    assert [g for g in got if g[0] in (0, 1, 2, 3, 5, 6, 7)] == [
        (0, 2, None, True), (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (5, 1, 5, True), (6, 2, 6, True),
        (6, 2, 6, True), (7, 2, 6, False)]
    assert sorted(r.doc_id or 0 for r in near_dedup.deduplicated(hard).collect()) == [0, 1, 2, 3, 4, 5, 6, 8, 9]
    assert near_dedup.near_duplicates(none).count() == 0


def test_passages(docs, texts):
    lines = {(i, k): l for i, t in texts.items() for k, l in enumerate(t.split("\n")) if len(l.split()) >= passages.MIN_WORDS}
    want = linked({k: shingles(l) for k, l in lines.items()})
    often = Counter(want.values())
    got = passages.repeated_passages(docs).collect()
    assert {(r.doc_id, r.para): (r.component_id, r.component_para) for r in got} == {k: c for k, c in want.items() if often[c] > 1}
    assert all(texts[r.doc_id][r.start:r.end] == lines[r.doc_id, r.para] for r in got)


def test_passages_hard(hard, none):
    assert passages.repeated_passages(hard).count() == 0 and passages.repeated_passages(none).count() == 0
    found = passages.repeated_passages(hard, min_words=2)
    left = {r.doc_id: r.text for r in passages.without_passages(hard, found).collect() if r.doc_id}
    assert left[7] == "" and left[6] == HARD[5][1] and left[1] is None


def test_passages_any_lines(spark):
    """Every word of a 50-word window found at two places, counted over whole texts, is in some row."""
    docs = table(spark, SF_MORE, "documents")
    places, at, texts = defaultdict(list), {}, {r.doc_id: r.text for r in docs.collect()}
    for i, t in texts.items():
        at[i] = list(WORD.finditer(t))
        low = [m[0].encode().lower() for m in at[i]]
        for p in range(len(low) - 49):
            places[hash(tuple(low[p:p + 50]))].append((i, p))
    want, copies = defaultdict(set), defaultdict(set)
    for found in places.values():
        first, last = min(found), max(found)
        if first[0] != last[0] or last[1] - first[1] >= 50:
            for i, p in found:
                want[i].update(range(p, p + 50))
                copies[i].update(range(p, p + 50) if i != first[0] or p - first[1] >= 50 else ())
    got = queries.op5_substring_dedup(spark, SF_MORE).collect()
    spans, cut, rows = defaultdict(set), defaultdict(set), defaultdict(set)
    for r in got:
        inside = {k for k, m in enumerate(at[r.doc_id]) if r.start <= m.start() and m.end() <= r.end}
        rows[r.doc_id] |= inside
        if r.para is None:
            assert len(inside) == r.n_shingles + 4 >= 50
            spans[r.doc_id] |= inside
            cut[r.doc_id] |= inside if r.removed else set()
    assert all(w <= rows[i] for i, w in want.items())
    assert dict(spans) == dict(want) and {i: c for i, c in cut.items() if c} == {i: c for i, c in copies.items() if c}


def test_passages_moved_once(docs, monkeypatch):
    """Seeds and band keys are shuffled once, not to count them and again to join them."""
    plans, write = {}, linking.cut

    def cut(df, name, *how):
        plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString())
        return write(df, name, *how)
    for module in (passages, spans, linking):
        monkeypatch.setattr(module, "cut", cut)
    passages.passages_and_spans(docs)
    assert [plans[n].count("Exchange hashpartitioning") for n in ("shared-seeds", "members")] == [1, 1]


def test_many_near_copies(spark, monkeypatch):
    """Components of a large group of near copies, many of them linked to none, are those of all pairs; what
    is compared grows with the group, not with its square."""
    pairs, meet = [], linking._meet

    def met(d):
        pairs.append(d.count())
        return meet(d)
    monkeypatch.setattr(linking, "_meet", met)
    draw = np.random.default_rng(3)
    lines = {k: [f"w{j}" if draw.random() >= 0.02 + 0.08 * (k % 2) else f"x{k}-{j}" for j in range(80)] for k in range(400)}
    d = spark.createDataFrame([(k, " ".join(l)) for k, l in lines.items()], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in passages.repeated_passages(d).collect()}
    want = linked({k: shingles(" ".join(l)) for k, l in lines.items()})
    often = Counter(want.values())
    assert len(often) > 50 and got == {k: c for k, c in want.items() if often[c] > 1}
    assert len(pairs) == 2 and sum(pairs) < 100 * len(lines)


def test_texts_likely_wanted(docs):
    d = passages._bodies(docs)
    wanted = {r.doc_id for r in d.collect()[::7]}
    kept = [r.doc_id for r in passages._likely(d, d.where(F.col("doc_id").isin(wanted)).select("doc_id", "body")).collect()]
    assert wanted <= set(kept) and len(kept) <= len(wanted) + 2


def test_words():
    """Equal words, and only these, have equal hashes; places as a regular expression finds them."""
    parts = ["a" * n for n in range(1, 140)] + ["A" * 9, "x\0", "x\0\0", "x", "\u00e9t\u00e9", "\u00c9t\u00e9", "\U0001f600!", "\ud800z", "\u00a0", "\u2003y"]
    texts = ["", " \t\n", "\n".join(parts), "\r\n".join(parts[::-1]) + "\n", "", "x"]
    t, joined = sketch.Words(texts), "\n".join(texts)
    found = list(WORD.finditer(joined))
    assert [m.span() for m in found] == list(zip(t.starts.tolist(), t.ends.tolist()))
    low = [m[0].encode("utf-8", "surrogatepass").lower() for m in found]
    assert len(set(low)) == len(set(t.hashes.tolist())) == len(set(zip(low, t.hashes.tolist())))
    lines = [joined[a:e] for a, e in zip(t.line_starts, t.line_ends)]
    assert lines == joined.split("\n") and t.line_count.tolist() == [len(WORD.findall(x)) for x in lines]
    assert t.count.tolist() == [len(WORD.findall(x)) for x in texts]


def test_spans_hard(spark, hard, none):
    passage = [f"w{k}" for k in range(60)]
    rows = [(1, "head " + " ".join(passage) + " tail"),
            (2, "other\n" + "\n".join(" ".join(passage[k:k + 10]).upper() for k in range(0, 60, 10)) + "\nend"),
            (3, " ".join(passage[:25]) + "\n" + " ".join(passage[25:49]) + " x"), (4, None), (None, " ".join(passage)), (5, "lorem " * 99), (6, "ipsum " * 100)]
    d = spark.createDataFrame(rows + rows[:1], "doc_id long, text string")
    found = passages.passages_and_spans(d)
    got = sorted((r.doc_id, r.para, r.start, r.end, r.component_id, r.removed) for r in found.collect() if r.doc_id < 5)
    n = len(" ".join(passage))
    assert got == [(1, None, 5, 5 + n, 1, False), (2, None, 6, 6 + n, 1, True)]
    left = {r.doc_id: r.text for r in passages.without_passages(d, found).collect()}
    assert left[1] == rows[0][1] and left[2] == "other\n\nend" and left[3] == rows[2][1] and left[4] is None
    assert left[5] == rows[5][1] and left[6].split() == ["ipsum"] * 50
    assert {r.doc_id for r in passages.passages_and_spans(hard).collect()} == {5} and passages.passages_and_spans(none).count() == 0


def test_mixing(docs, texts):
    got = queries.op2_source_mixing(docs.sparkSession, SF).collect()
    again = queries.op2_source_mixing(docs.sparkSession, SF).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    source = {r.doc_id: r.source for r in docs.collect()}
    size, taken, target = Counter(), Counter(), {}
    for r in got:
        assert r.size == len(WORD.findall(texts[r.doc_id])) and 0 <= r.taken <= 2 * r.size
        s = source[r.doc_id]
        size[s] += r.size
        taken[s] += r.taken
        target[s] = r.target
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sorted(size))}
    left, open_ = 1.5 * sum(size.values()), set(size)
    while full := {s for s in open_ if left * weight[s] / sum(weight[t] for t in open_) > 2 * size[s]}:
        left, open_ = left - sum(2 * size[s] for s in full), open_ - full
    for s in size:
        want = left * weight[s] / sum(weight[t] for t in open_) if s in open_ else 2 * size[s]
        assert target[s] == pytest.approx(want)
        assert abs(taken[s] - want) <= 16 + max(r.size for r in got if source[r.doc_id] == s)


def test_mixing_hard(hard, none):
    p = mixing.plan(hard).collect()
    assert len(p) == len(HARD) and {r.size for r in p} >= {0, 1, 30_000}
    assert all(len(r.copies) <= 2 for r in p)
    assert mixing.mixed(hard, shards=3).columns == hard.columns and mixing.plan(none).count() == 0


def test_mixing_colours_and_shards(spark, docs, monkeypatch):
    """Many sources share colours, are joined with salt, and large shards are dealt to several tasks: every
    source still misses its target by half a block and half a document at most, and each copy is dealt once."""
    monkeypatch.setattr(mixing, "FEW_SOURCES", 0)
    monkeypatch.setattr(mixing, "SHARD_WORDS", 2000)
    monkeypatch.setattr(mixing, "MOST_SHARDS", 4)
    many = docs.withColumn("source", F.concat("source", F.lit("-"), F.col("doc_id") % 3))
    p = mixing.plan(many, colours=5).collect()
    taken, target, longest = Counter(), {}, Counter()
    for r in p:
        taken[r.source] += r.size * len(r.copies)
        target[r.source] = r.target
        longest[r.source] = max(longest[r.source], r.size)
        assert all(0 <= c.shard < 4 for c in r.copies)
    assert len(target) > 15 and all(abs(taken[s] - w) <= 16 + longest[s] for s, w in target.items())
    mix = mixing.mixed(many, colours=5)
    parts = mix.select("doc_id", F.spark_partition_id().alias("part")).collect()
    assert Counter(r.doc_id for r in parts) == Counter({r.doc_id: len(r.copies) for r in p if r.copies})
    want = {(r.doc_id, c.shard) for r in p for c in r.copies}
    tasks = mixing.enough_shards(int(sum(target.values())))[1]
    assert tasks > 1 and mix.rdd.getNumPartitions() == 4 * tasks
    assert {(r.doc_id, r.part // tasks) for r in parts} == want and len({r.part for r in parts}) > 2 * tasks


def test_splitting_tree():
    quotas = np.array([50, 0, 7, 1000])
    parts = [mixing.leaf(quotas, 7, k, 3) for k in range(7)]
    assert (sum(h for _, h in parts) == quotas).all()
    at = np.zeros(4, int)
    for start, held in parts:  # runs follow one another, so they are disjoint
        assert (start == at).all()
        at = at + held
    sizes = [int(h.sum()) for _, h in parts]
    assert max(sizes) - min(sizes) <= 3


def base(text):
    w = WORD.findall(text or "")
    grams = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
    often = Counter(grams)
    covered = {k + j for k, g in enumerate(grams) if often[g] > 1 for j in range(3)}
    lines = [l for l in (text or "").split("\n") if WORD.search(l)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
            len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w))


def test_quality(spark, docs, texts):
    import xxhash
    got = {r.doc_id: r for r in queries.op3_quality_rules(spark, SF).collect()}
    assert {i: tuple(r)[1:7] for i, r in got.items()} == {i: base(t) for i, t in texts.items()}
    good = {r.doc_id for r in table(spark, SF, "labels").where("quality = 1").collect()}

    def signed(h):
        return h - (1 << 64) if h >= 1 << 63 else h

    def grams(text):
        one = [xxhash.xxh64_intdigest(w.encode(), 42) for w in WORD.findall(text)]
        long = [x.to_bytes(8, "little") for x in one]
        two = [xxhash.xxh64_intdigest(b, xxhash.xxh64_intdigest(a, 42)) for a, b in zip(long, long[1:])]
        return [signed(h) % (1 << 16) for h in one + two + [xxhash.xxh64_intdigest(a, 42) for a in long[-1:]]]
    raw, trusted = Counter(), Counter()
    for i, t in texts.items():
        raw.update(grams(t))
        trusted.update(grams(t) if i in good else ())
    share = sum(trusted.values()) / sum(raw.values())
    for i, t in texts.items():
        g = grams(t)
        score = sum(np.log((trusted[b] + 20) / (raw[b] * share + 20)) for b in g) / len(g) if g else 0.0
        assert got[i].score == pytest.approx(score, abs=1e-9)
        assert got[i].kept == (not got[i].base_failed and got[i].score >= -0.075)


def test_quality_hard(spark, hard, none):
    ids = spark.createDataFrame([(1,), (6,), (6,), (None,)], "doc_id long")
    got = quality.quality(hard, ids).collect()
    assert sorted(tuple(r)[1:7] for r in got) == sorted(base(t) for _, t in HARD)
    assert quality.quality(none, ids).count() == 0
    assert {r.score for r in quality.quality(hard, ids.limit(0)).collect()} == {0.0}
    assert quality.kept_documents(hard, ids).columns == hard.columns


def secret_spans(text):
    kinds = [("assign", re.compile(secret_scans.BASE_RULES[0].pattern.replace("(?i)", ""), re.I | re.A), 2, 6),
             ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20), ("hex", re.compile("[0-9a-f]+"), 0, 24)]
    found = [(m.start(), k, name, m.end()) for k, (name, p, group, least) in enumerate(kinds)
             for m in p.finditer(text or "") if len(m[group]) >= least]
    return ",".join(f"{name}:{a}:{b}" for a, _, name, b in sorted(found))


def test_secrets(spark, hard, none, tmp_path):
    texts = {r.doc_id: r.text for r in table(spark, SF_MORE, "documents").collect()}
    got = queries.op10_secret_scans(spark, SF_MORE).collect()
    want = {i: secret_spans(t) for i, t in texts.items()}
    assert {r.doc_id: r.base_sha256 for r in got} == {i: hashlib.sha256(s.encode()).hexdigest() for i, s in want.items()}
    assert any(want.values()) and all(r.n_hex == want[r.doc_id].count("hex") for r in got)
    ledger = str(tmp_path / "ledger")
    first = {r.doc_id: r.spans for r in secret_scans.digest(secret_scans.find_secrets(hard, ledger)).collect()}
    assert first[8] == secret_spans(HARD[9][1]) != "" and first[1] == ""
    size = spark.read.parquet(ledger).count()
    assert size == len({t or "" for _, t in HARD})  # one row for a text, however many rows hold it
    secret_scans.find_secrets(hard, ledger).count()
    assert spark.read.parquet(ledger).count() == size  # nothing unseen, nothing scanned
    assert secret_scans.find_secrets(none).count() == 0
    clean = {r.doc_id: r.text for r in secret_scans.redact(hard).collect()}
    assert clean[8] == "[SECRET] token: abc\n[SECRET]'" and clean[1] is None and clean[5] == HARD[4][1]


def test_redacted_keys(spark):
    """No line of a private key's body is left, with or without its END line; the text around it is."""
    import base64
    body = [base64.b64encode(hashlib.sha384(bytes([k])).digest()).decode() for k in range(40)] + ["q83vEg=="]
    long = body * 60

    def key(lines, kind="", end="\n", closed=True):
        tail = [f"-----END {kind}PRIVATE KEY-----"] if closed else []
        return end.join([f"-----BEGIN {kind}PRIVATE KEY-----", *lines, *tail])
    head = ["Proc-Type: 4,ENCRYPTED", "DEK-Info: AES-128-CBC,0123456789ABCDEF", ""]
    m = "[SECRET]"
    cases = [(f"before\n{key(body)}\nafter the key", f"before\n{m}\nafter the key"),
             (f"before\n{key(body, 'RSA ', closed=False)}\nafter the key", f"before\n{m}\nafter the key"),
             (f"{key(body, 'EC ', chr(13) + chr(10))}\r\nafter", f"{m}\r\nafter"),
             (f"x {key(head + body, 'RSA ')} y", f"x {m} y"),
             (f"x {key(head + body, 'RSA ', closed=False)}\n\nso it ends", f"x {m}\n\nso it ends"),
             (f"{key(body, closed=False)}\ncut off here\n{key(long)}\nend", f"{m}\ncut off here\n{m}\nend"),
             ('{"k": "' + key(body, end="\\n") + '\\n"}', '{"k": "' + m + '\\n"}'),
             (key(body, end=" ", closed=False), m), (key(["> " + x for x in body]) + "\nz", f"{m}\nz"),
             (key(long, closed=False)[:-3] + "", m), ("-----BEGIN PRIVATE KEY-----", m),
             ("-----BEGIN CERTIFICATE-----\nplain\n-----END CERTIFICATE-----",) * 2]
    d = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(cases)], "doc_id long, text string")
    left = {r.doc_id: r.text for r in secret_scans.redact(d).collect()}
    assert left == {k: want for k, (_, want) in enumerate(cases)}
    found = secret_scans.digest(secret_scans.find_secrets(d)).collect()  # base spans stay as they are
    assert {r.doc_id: r.base_sha256 for r in found} == {
        k: hashlib.sha256(secret_spans(t).encode()).hexdigest() for k, (t, _) in enumerate(cases)}


def test_redaction_of_many_spans(spark):
    """Texts with tens of thousands of secrets, some overlapping, more than a block apart or side by side."""
    import random
    rng = random.Random(4)
    parts = ["token=" + "a1" * 14 + " ", "é𝒳☃ " * 90, "AKIA" + "A" * 16, "x ", "0123456789abcdef" * 2 + ";", "password: short "]
    cases = ["".join(rng.choices(parts, k=k)) for k in (1, 300, 20_000)] + ["token=abcdef" * 700, "token=" + "b" * 256, "", None]
    d = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")

    def plain(text):
        out, at = [], 0
        for _, start, end in (s.split(":") for s in filter(None, secret_spans(text or "").split(","))):
            if int(start) >= at:
                out.append(text[at:int(start)] + "[SECRET]")
            at = max(at, int(end))
        return "".join(out) + text[at:] if text is not None else None
    assert {r.doc_id: r.text for r in secret_scans.redact(d).collect()} == {k: plain(t) for k, t in enumerate(cases)}
    found = {r.doc_id: r.spans for r in secret_scans.digest(secret_scans.find_secrets(d)).collect()}
    assert found == {k: secret_spans(t or "") for k, t in enumerate(cases)}


def test_pieces(spark, hard, none):
    model = pieces.load(spark)
    codec = pieces.Codec(model)
    score = {p: s for p, s, k in zip(model.piece, model.score, model.kind) if k == pieces.NORMAL}

    def brute(s):
        best = [0.0] + [-np.inf] * len(s)
        for end in range(1, len(s) + 1):
            best[end] = max([best[a] + score[s[a:end]] for a in range(max(0, end - 50), end) if s[a:end] in score]
                            + ([best[end - 1] + codec.unknown] if s[end - 1] not in score else []))
        return best[-1]
    total = lambda ids: sum(score[model.piece[i]] for i in ids)
    for text in ("the quick brown fox", "Enti a wherer, anhe ntedin", "une écoleentière"):
        ids = np.frombuffer(codec.ids(text), np.int32)
        assert total(ids) == brute(("▁" + text).replace(" ", "▁"))
    got = pieces.encode(hard)
    back = sorted((r.doc_id or 0, r.text) for r in pieces.decode(got).collect())
    assert back == sorted((i or 0, t or "") for i, t in HARD)
    assert pieces.encode(none).count() == 0
    assert queries.op6_sentencepiece(spark, SF).where("not exact").count() == 0


def test_pieces_space_mark(spark):
    """A space mark in the text itself comes back as it was."""
    texts = ["a▁b", "▁", "▁▁ ▁x", "▁ lead", "trail▁", " ▁\n▁ two  words▁", "plain text", " plain"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.text for r in pieces.decode(pieces.encode(d)).orderBy("doc_id").collect()] == texts
    assert pieces.encoded_and_checked(d).where("exact").count() == len(texts)
    codec = pieces.Codec(pieces.load(spark))
    assert codec.ids("a▁b") != codec.ids("a b")
    codec.bytes = {}  # a model without byte pieces cannot hold the mark, and the check must tell
    assert codec.decode(np.frombuffer(codec.ids("a▁b"), np.int32).tolist()) != "a▁b"


def test_toxicity(spark, hard, none):
    labels = table(spark, SF_MORE, "labels")
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    got = queries.op7_toxicity(spark, SF_MORE).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.9 * len(held)
    odd = toxicity.toxicity(hard, labels).collect()
    assert len(odd) == len(HARD) and all(0 <= r.score <= 1 for r in odd)
    assert toxicity.toxicity(none, labels).count() == 0
    assert {r.score for r in toxicity.toxicity(hard, labels.limit(0)).collect()} == {0.5}


def top(rows, k=5, every=50):
    out = []
    v = {i: np.floor(np.array(x, float) * 256).astype(int) for i, x in rows}
    for q in v:
        if q % every == 0:
            best = sorted((-int(v[q] @ v[i]), i) for i in v if i != q and len(v[i]) == len(v[q]))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


def test_vectors(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF_MORE, "embeddings").collect()]
    assert sorted(map(tuple, queries.op8_exact_top_k(spark, SF_MORE).collect())) == top(rows)
    some = [(i, [0.5, -0.25] if i < 70 else [0.1 * (i % 7), 0.3]) for i in range(120)]  # many equal vectors
    odd = [(150, None), (200, [1.0, None]), (250, [float("nan"), 1.0]), (300, [float("inf"), 1.0]), (None, [1.0, 1.0]),
           (350, [])]
    t = spark.createDataFrame(some + odd + [some[0]], "vec_id long, embedding array<float>")
    want = top([(i, np.array(x, np.float32)) for i, x in some])
    assert sorted(map(tuple, vectors.top_k(t).collect())) == want
    assert sorted(map(tuple, vectors.top_k(t, file_vectors=3, query_block=1).collect())) == want
    assert vectors.top_k(t.limit(0)).count() == 0


def test_packing(spark, hard, none):
    got = packing.packed(hard, length=64, shard_chars=50_000).collect()
    enc = packing.encoder(open(packing.RANKS, "rb").read())
    parts = defaultdict(list)
    for r in got:
        ids, places = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.positions, "<u2")
        assert len(ids) == 64 and r.cu_seqlens[-1] == r.n_tokens <= 64 and (ids[r.n_tokens:] == packing.END).all()
        for d, p, a, b in zip(r.doc_ids, r.parts, r.cu_seqlens, r.cu_seqlens[1:]):
            assert places[a:b].tolist() == list(range(b - a))
            parts[d].append((p, ids[a:b].tolist()))
    for i, t in HARD:
        if i != 6:
            assert [x for _, p in sorted(parts[i]) for x in p] == enc.encode_ordinary(t or "")
    assert len(parts[6]) == 2 and packing.packed(none).count() == 0
    lengths = np.random.default_rng(1).integers(1, 60, 500).tolist()
    rooms, want = [], 0
    for n in sorted(lengths, reverse=True):  # best fit by looking at all rows
        fits = [k for k, room in enumerate(rooms) if room >= n]
        if fits:
            k = min(fits, key=lambda k: rooms[k])
            rooms[k] -= n
        else:
            rooms.append(64 - n)
    rows = packing.best_fit_decreasing(lengths, 64)
    assert len(rows) == len(rooms) and sorted(i for r in rows for i in r) == list(range(500))
    assert all(sum(lengths[i] for i in r) <= 64 for r in rows)


def test_urls(spark):
    from datetime import date
    e = [("bad", "x.com", date(2024, 1, 5), "add"), ("bad", "x.com", date(2024, 1, 8), "remove"),
         ("bad", "x.com", date(2024, 1, 8), "remove"), ("ads", "x.com", date(2024, 1, 6), "add"),
         ("bad", "y.org/a", date(2024, 1, 1), "add"), ("bad", "y.org/a", date(2024, 1, 1), "remove"),
         ("bad", None, date(2024, 1, 1), "add"), ("bad", "z.net", date(2024, 1, 9), "remove")]
    entries = spark.createDataFrame(e, "list string, key string, date date, action string")
    c = [(1, "http://www.X.com:80/q?a=1", 4), (2, "https://x.com", 5), (3, "x.com/", 7), (4, "http://u@x.com/a/b#f", 8),
         (5, "http://y.org/a/b/c", 3), (6, "http://y.org/ab", 3), (7, None, 3), (8, "", 3), (9, "http://x.com", None),
         (3, "x.com/", 7), (10, "http://z.net/", 20), (11, "http://notx.com/", 7)]
    caps = spark.createDataFrame([(i, u, d and date(2024, 1, d), "k") for i, u, d in c], "page_id long, url string, fetched date, key string")
    got = sorted((r.page_id, r.list, r.key) for r in urls.judged(caps, entries).collect() if r.blocked)
    assert got == [(2, "bad", "x.com"), (3, "ads", "x.com"), (3, "ads", "x.com"), (4, "ads", "x.com"), (5, "bad", "y.org/a")]
    assert urls.judged(caps, entries).count() == len(c) and urls.judged(caps.limit(0), entries).count() == 0
    assert urls.judged(caps, entries.limit(0)).where("blocked").count() == 0


def test_pipeline(spark):
    import corpus_pipeline
    docs = table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
    kept = {r.doc_id for r in quality.quality(docs, queries.trusted_ids(spark, SF)).where("kept").collect()}
    got = corpus_pipeline.run(spark, SF).collect()
    sets = {r.doc_id: shingles(r.text) for r in docs.collect() if r.doc_id in kept}
    heads = set(linked(sets).values())
    assert {r.doc_id for r in got} <= heads and all(r.exact for r in got)
    assert max(Counter(r.doc_id for r in got).values()) <= 2
