"""Published year-over-year results (season, measure, [(year, value, trend), ...]).

Fixed values: recomputing `trend` from `value` must give exactly these numbers.
All nine measures of both seasons; 2017 is the first of the four years, so its trend is 0.0 by
definition. The Max/Min Wind Speed values are the large doubles the original produced by reading
double bits as integers (defect Q2); the trend arithmetic must still reproduce them.
"""

GOLDEN_TRENDS = [
    ("summer", "Max Temperature", [(2017, -15.44, 0.0), (2018, -13.91, 9.91), (2019, -18.84, -35.44), (2020, -17.38, 7.75)]),
    ("summer", "Min Temperature", [(2017, -50.45, 0.0), (2018, -48.53, 3.81), (2019, -51.82, -6.78), (2020, -45.03, 13.1)]),
    ("summer", "AVG Temperature", [(2017, -31.85, 0.0), (2018, -31.61, 0.75), (2019, -32.4, -2.5), (2020, -29.82, 7.96)]),
    ("summer", "Max Wind Speed", [(2017, 4.625385405543895E18, 0.0), (2018, 4.6245043888667914E18, -0.02), (2019, 4.6252277795569377E18, 0.02), (2020, 4.6226804310177065E18, -0.06)]),
    ("summer", "Min Wind Speed", [(2017, 4.5999766593962245E18, 0.0), (2018, 4.6088937866584182E18, 0.19), (2019, 4.5942120518731904E18, -0.32), (2020, 4.6121138603919882E18, 0.39)]),
    ("summer", "AVG Wind Speed", [(2017, 8.04, 0.0), (2018, 7.84, -2.49), (2019, 8.04, 2.55), (2020, 7.03, -12.56)]),
    ("summer", "Max Humidity", [(2017, 91.0, 0.0), (2018, 86.0, -5.49), (2019, 87.0, 1.16), (2020, 97.0, 11.49)]),
    ("summer", "Min Humidity", [(2017, 50.0, 0.0), (2018, 55.0, 10.0), (2019, 54.0, -1.82), (2020, 65.0, 20.37)]),
    ("summer", "AVG Humidity", [(2017, 68.72, 0.0), (2018, 69.28, 0.81), (2019, 68.59, -1.0), (2020, 77.26, 12.64)]),
    ("winter", "Max Temperature", [(2017, -27.85, 0.0), (2018, -29.64, -6.43), (2019, -33.37, -12.58), (2020, -25.09, 24.81)]),
    ("winter", "Min Temperature", [(2017, -64.2, 0.0), (2018, -61.16, 4.74), (2019, -65.1, -6.44), (2020, -54.54, 16.22)]),
    ("winter", "AVG Temperature", [(2017, -48.09, 0.0), (2018, -45.61, 5.16), (2019, -47.47, -4.08), (2020, -43.37, 8.64)]),
    ("winter", "Max Wind Speed", [(2017, 4.6257288050154824E18, 0.0), (2018, 4.6260299832405627E18, 0.01), (2019, 4.6256922132685097E18, -0.01), (2020, 4.62573161976525E18, 0.0)]),
    ("winter", "Min Wind Speed", [(2017, 4.6083533547031337E18, 0.0), (2018, 4.6121138603919882E18, 0.08), (2019, 4.6117085364255252E18, -0.01), (2020, 4.6116409824311142E18, 0.0)]),
    ("winter", "AVG Wind Speed", [(2017, 10.15, 0.0), (2018, 10.45, 2.96), (2019, 9.82, -6.03), (2020, 9.5, -3.26)]),
    ("winter", "Max Humidity", [(2017, 91.0, 0.0), (2018, 86.0, -5.49), (2019, 89.0, 3.49), (2020, 100.0, 12.36)]),
    ("winter", "Min Humidity", [(2017, 24.0, 0.0), (2018, 48.0, 100.0), (2019, 52.0, 8.33), (2020, 35.0, -32.69)]),
    ("winter", "AVG Humidity", [(2017, 65.59, 0.0), (2018, 65.61, 0.03), (2019, 65.98, 0.56), (2020, 86.49, 31.09)]),
]
