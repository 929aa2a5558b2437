"""Prefix trie, tokenizer alignment and sequence packing against plain brute-force versions."""
import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st

from obslake.llm import alignment, prefix_trie, queries, sequence_packing
from obslake.llm.common import table

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, node string, row long, ids string, length int, pairs int, grp int"
HARD = [(1, None), (2, ""), (3, " "), (4, "  a  b \n"), (5, "lorem ipsum " * 20_000), (6, "x" * 9000), (6, "x" * 9000), (None, "same words"),
        (None, None), (7, "\n\nline\n line\r\nénd\t tab nbsp em ́combining"), (8, "mark ▁ inside"), (9, "<|endoftext|> <s> <0x0A> </s>"),
        (10, "☃𝒳日本語テキスト" * 50), (11, "Don't we're 12345 it's\x1cfs\x00nul"), (12, "trailing   "), (13, "İstanbul ΣΑΣ ﬁ é")]


@pytest.fixture(scope="module")
def hard(spark):
    return spark.createDataFrame([(i, t, None, None, "z", 1, "z", 1, 1, 1) for i, t in HARD], SCHEMA)


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]


# --- prefix trie --------------------------------------------------------------------------------

def plain_trie(rows):
    """Nodes by plain sequences; rows (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - c % 5, [])[:h] + ts[h:]
    members = defaultdict(list)
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in children[p]) if children[p] else 1
        saved[p] = sum(saved[k] for k in children[p]) + (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(built[c]) == len(p)).encode()).hexdigest())
                  for p, m in members.items())


def trie_rows(df):
    return sorted(tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                              "saved_tokens", "ends_sha256").collect())


CONVERSATION = "conv_id long, turn long, role string, text string, node string, shard int, pos int"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "z", 1, 1) for r in rows], CONVERSATION)


def test_trie_of_table(spark):
    rows = [tuple(r) for r in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert trie_rows(queries.op11_conversation_trie(spark, SF)) == plain_trie(rows)


def made(n=400, seed=5):
    """Conversations from few turns, so that many share prefixes: long chains, exact copies, one hot
    first turn, ids without a base, nulls, empty texts, repeated turns."""
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(3, 3 + n):
        if c % 17 == 0:
            continue
        hot = c % 3 == 0
        for t in range(int(rng.integers(1, 14))):
            rows.append((c, t if t else None, "user" if t % 2 else None, "hot" if hot and t < 10 else ["é", "b", None, ""][int(rng.integers(4))]))
    for c in (1000, 1001, 1002, 1005):  # copies deeper than a band, one of them shorter
        rows += [(c, t, "user", f"deep {t}") for t in range(60 if c != 1002 else 40)]
    rows += [(2000, 1, "user", "same"), (2000, 1, "user", "same"), (2000, 1, "user", "other"), (None, 1, "user", "nobody")]
    return rows


@pytest.mark.parametrize("shard_rows, table_rows", [(1 << 16, 1 << 20), (40, 1 << 20), (40, 7), (1, 1)])
def test_trie_of_shared_prefixes(spark, shard_rows, table_rows):
    rows = made(120 if table_rows < 10 else 400) if table_rows > 1 else [r for r in made(30) if r[0] is None or r[0] < 1000]
    assert trie_rows(prefix_trie.trie(conversations(spark, rows), shard_rows, table_rows)) == plain_trie(rows)


def test_trie_small(spark):
    assert trie_rows(prefix_trie.trie(conversations(spark, []))) == []
    one = [(7, 1, "user", "a"), (7, 2, "user", "b")]
    assert trie_rows(prefix_trie.trie(conversations(spark, one))) == plain_trie(one)


def test_node_table():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 62, (5000, 2)).astype(np.uint64), axis=0)
    t = prefix_trie.NodeTable(keys)
    assert sorted(t.slots(keys)) == list(range(len(keys)))
    other = keys.copy()
    other[:, 1] += np.uint64(1)
    held = {tuple(k) for k in keys.tolist()}
    assert all(s < 0 or tuple(k) in held for k, s in zip(other.tolist(), t.slots(other).tolist()))
    with pytest.raises(ValueError):
        prefix_trie.NodeTable(np.concatenate([keys[:5], keys[:1]]))


def test_ends_in_lists(spark):
    rows = spark.createDataFrame([(b"x" * 16, i) for i in range(500)] + [(b"y" * 16, 7)], "node binary, conv_id long")
    got = {bytes(r.node): r.ends_sha256 for r in prefix_trie._ends(rows, most=7).collect()}
    assert got == {b"x" * 16: hashlib.sha256(",".join(map(str, range(500))).encode()).hexdigest(),
                   b"y" * 16: hashlib.sha256(b"7").hexdigest()}


# --- alignment ------------------------------------------------------------------------------------

def plain_alignment(docs):
    """Whole texts through the two libraries, ends as sets, all pairs of a group."""
    import sentencepiece
    from tokenizers import Tokenizer
    first = Tokenizer.from_file(public_tokenizers.path(alignment.FIRST))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(alignment.SECOND))
    letters = alignment._byte_letters()
    out, count = [], Counter()
    for i, text in docs:
        whole = (" " + text).encode() if text else b""
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        ba = [bytes(letters[c] for c in first.id_to_token(x)) for x in a]
        pieces = [second.id_to_piece(x) for x in b]
        bb = [bytes([int(p[3:5], 16)]) if second.is_byte(x) else p.replace("▁", " ").encode() for x, p in zip(b, pieces)]
        if b"".join(ba) != whole or b"".join(bb) != whole:
            a, b, ba, bb = [], [], [], []
        ea, eb = np.cumsum([len(x) for x in ba]).tolist(), np.cumsum([len(x) for x in bb]).tolist()
        both = set(ea) & set(eb)
        said, links, x, y = [], [], 0, 0
        for e in sorted(both):
            u, v = ea.index(e, x) + 1, eb.index(e, y) + 1
            said.append(",".join(map(str, a[x:u])) + "|" + ",".join(map(str, b[y:v])))
            links += [(p, q) for p in a[x:u] for q in b[y:v]]
            x, y = u, v
        count.update(set(links))
        out.append((i, len(a), len(b), len(said), links, hashlib.sha256(";".join(said).encode()).hexdigest() if a else ""))
    most = defaultdict(int)
    for (p, _), n in count.items():
        most[p] = max(most[p], n)
    key = lambda r: tuple((x is not None, x) for x in r)
    return sorted(((i, na, nb, ng, len(links), sum(count[x] == most[x[0]] for x in links), sum(count[x] for x in links), sha)
                   for i, na, nb, ng, links, sha in out), key=key)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def _sorted(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=lambda r: tuple((x is not None, x) for x in r))


def test_alignment_of_table(spark, documents):
    assert _sorted(queries.op12_tokenizer_alignment(spark, SF)) == plain_alignment(documents)


@pytest.mark.parametrize("table_pairs", [1 << 20, 50])
def test_alignment_hard(spark, hard, table_pairs):
    docs = [d for d in HARD if d[0] != 5]
    got = _sorted(alignment.scored(hard.where("doc_id is null or doc_id <> 5"), table_pairs))
    assert got == plain_alignment(docs)
    long_ = alignment.aligned(hard.where("doc_id = 5")).first()
    assert long_.n_a == plain_alignment([HARD[4]])[0][1]


def test_alignment_empty(spark, hard):
    assert alignment.scored(hard.where("false")).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 300)), st.sets(st.integers(0, 3000)), st.booleans())
def test_gallop(a, b, turn):
    a, b = (np.array(sorted(x), np.int64) for x in ((b, a) if turn else (a, b)))
    i, j = alignment.gallop(a, b)
    assert a[i].tolist() == b[j].tolist() == sorted(set(a.tolist()) & set(b.tolist()))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t.'śé日▁ \x1c1", max_size=30), max_size=4))
def test_aligner_parts(texts):
    """Texts cut into parts come out as whole texts do."""
    if not hasattr(test_aligner_parts, "sides"):
        test_aligner_parts.sides = (alignment.ByteLevel(open(public_tokenizers.path(alignment.FIRST), "rb").read()),
                                    alignment.Pieces(open(public_tokenizers.path(alignment.SECOND), "rb").read()))
    figures, said, (doc, _, times) = alignment.Aligner(*test_aligner_parts.sides, most=10).of(texts)
    for k, (i, na, nb, ng, nl, *_, sha) in enumerate(r for j, t in enumerate(texts) for r in plain_alignment([(j, t)])):
        assert figures[k].tolist() == [na, nb, ng, nl] and nl == times[doc == k].sum()
        assert (hashlib.sha256(said[k].encode()).hexdigest() if said[k] else "") == sha


def test_many_tokens_in_a_group():
    a = alignment.Aligner.__new__(alignment.Aligner)
    ids_a, ids_b = np.array([1, 2, 1, 3] * 50), np.array([5, 6] * 50)
    x, y = np.array([0, 1, 200]), np.array([0, 1, 100])
    g, pair, times = a._pairs(ids_a, ids_b, x, y)
    want = Counter({(0, 1 << alignment.ID_BITS | 5): 1})
    for p in ids_a[1:]:
        for q in ids_b[1:]:
            want[1, int(p) << alignment.ID_BITS | int(q)] += 1
    got = Counter()
    for k, p, n in zip(g.tolist(), pair.tolist(), times.tolist()):
        got[k, p] += n
    assert got == want


# --- packing --------------------------------------------------------------------------------------

def held_to_contract(docs, rows, length):
    """Pieces hold every id once, sequences are gapless; returns the share of padding."""
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path(sequence_packing.TOKENIZER))
    want = Counter((i, tuple(t.encode(x or "", add_special_tokens=False).ids + [2])) for i, x in docs)
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    got = Counter()
    for i, ps in by_doc.items():
        if len({(r.start, r.length) for r in ps}) < len(ps):  # repeated ids: compared by content only
            got.update({k: n for k, n in want.items() if k[0] == i})
            assert sum(r.length for r in ps) == sum(len(k[1]) * n for k, n in want.items() if k[0] == i)
            continue
        ids = [np.frombuffer(bytes(r.ids), "<u4").tolist() for r in sorted(ps, key=lambda r: r.start)]
        assert [r.start for r in sorted(ps, key=lambda r: r.start)] == np.cumsum([0, *map(len, ids[:-1])]).tolist()
        assert {r.doc_tokens for r in ps} == {sum(map(len, ids))}
        got[i, tuple(x for p in ids for x in p)] += 1
    assert got == want
    padding = 0
    for ps in by_seq.values():
        ps.sort(key=lambda r: r.offset)
        assert [r.offset for r in ps] == np.cumsum([0, *(r.length for r in ps[:-1])]).tolist()
        n = sum(r.length for r in ps)
        assert 0 < n <= length and all(r.length > 0 for r in ps)
        padding += 0 if n & (n - 1) == 0 else length - n
    return padding / sum(r.length for r in rows)


@pytest.mark.parametrize("length, group", [(4096, 2048), (256, 16)])
def test_packing_of_table(spark, documents, length, group):
    rows = sequence_packing.packed_pieces(table(spark, SF, "documents"), length=length, group=group).collect()
    assert held_to_contract(documents, rows, length) == 0


def test_packing_query(spark):
    pieces = sequence_packing.packed_pieces(table(spark, SF, "documents")).collect()
    want = Counter((r.doc_id, r.start, r.length, zlib.crc32(r.ids), r.doc_tokens, r.sequence_id, r.offset) for r in pieces)
    assert Counter(tuple(r) for r in queries.op13_sequence_packing(spark, SF).collect()) == want


def test_packing_hard(spark, hard):
    held_to_contract(HARD, sequence_packing.packed_pieces(hard, length=64, group=4).collect(), 64)
    assert sequence_packing.packed_pieces(hard.where("false")).collect() == []


def test_sequences(spark):
    pieces = sequence_packing.packed_pieces(table(spark, SF, "documents"), length=512, group=32).cache()
    by_seq = defaultdict(list)
    for r in pieces.collect():
        by_seq[r.sequence_id].append(r)
    got = sequence_packing.sequences(pieces).collect()
    assert len(got) == len(by_seq)
    for s in got:
        ps = sorted(by_seq[s.sequence_id], key=lambda r: r.offset)
        assert bytes(s.ids) == b"".join(bytes(p.ids) for p in ps) and s.n_tokens == s.cu_seqlens[-1] == len(s.ids) // 4
        assert (s.doc_ids, s.starts) == ([p.doc_id for p in ps], [p.start for p in ps])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet="aB.,' \n\t'sé_-1\"Σ́²\x1c\x85<|endotxfENDOFTEXT>", max_size=24), min_size=1, max_size=3))
def test_ids_of_parts(texts):
    """Texts cut into parts come out as whole texts do."""
    if not hasattr(test_ids_of_parts, "ids"):
        test_ids_of_parts.ids = sequence_packing.Ids(open(public_tokenizers.path(sequence_packing.TOKENIZER), "rb").read(), np.dtype("<u4"), most=20)
    got = [np.frombuffer(test_ids_of_parts.ids.of(x), "<u4").tolist() for x in texts]
    assert got == [test_ids_of_parts.ids.whole.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_first_fit(lengths):
    want, room = [], []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        k = next((k for k, r in enumerate(room) if r >= lengths[i]), len(room))
        if k == len(room):
            want.append([])
            room.append(64)
        want[k].append(i)
        room[k] -= lengths[i]
    assert sequence_packing.first_fit_decreasing(lengths, 64) == want
    held = sequence_packing.filled(want, lengths, 64)
    cover = sorted((i, at, n) for p in held for i, at, n in p)
    for i in range(len(lengths)):
        mine = [(at, n) for j, at, n in cover if j == i]
        assert sum(n for _, n in mine) == lengths[i] and [at for at, _ in mine] == np.cumsum([0, *(n for _, n in mine[:-1])]).tolist()
    assert all((n := sum(x for _, _, x in p)) <= 64 and n & (n - 1) == 0 for p in held)
