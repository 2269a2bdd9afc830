"""Small inputs and expected results shared by the tests."""

from __future__ import annotations

from datetime import datetime, timedelta

BASE = datetime(2024, 1, 1)

# Arrivals in seconds of two worked examples, windows of 5 s without and with 2 s of tolerated disorder.
IN_ORDER = [1, 4, 5, 6, 4, 10, 20]
DISORDERED = [1, 5, 6, 7, 3, 4, 10, 12, 10, 9, 8, 22]

# Two towns of one region; the second comes back to times that the first has passed.
TEMPERATURES = """Bavaria,Passau,0,3.25,2023-11-05 08:15:00
Bavaria,Passau,0,5.75,2023-11-05 08:15:29
Bavaria,Hof,0,-1.5,2023-11-05 08:15:31
Bavaria,Hof,1,-2.5,2023-11-05 08:15:59
Bavaria,Passau,1,4.5,2023-11-05 08:15:04
Bavaria,Passau,0,6.0,2023-11-05 08:16:00""".splitlines()

# One key comes again 1,000 units after its first line.
CLICKS = """71,9001,40,pv,1650000000
72,9002,40,pv,1650000000
73,9001,41,pv,1650000000
71,9001,40,pv,1650001000""".splitlines()


def at(seconds: float) -> datetime:
    return BASE + timedelta(seconds=seconds)


def arrivals(spark, seconds, key="a"):
    """Rows (k, v, ts, seq) in arrival order."""
    rows = [(key, int(s), at(s), i) for i, s in enumerate(seconds)]
    return spark.createDataFrame(rows, "k string, v bigint, ts timestamp_ntz, seq bigint")


def lines(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")
