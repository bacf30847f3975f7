"""Timeouts of a stream against gaps of the table, however the stream is cut."""

import datetime as dt
import random

from terrace.streaming.timeouts import replayed_silences

SCHEMA = "user_id long, event_id long, ts timestamp_ltz"


def test_timeouts_are_those_of_the_gaps_at_any_cut(spark, tmp_path):
    rng, at, rows = random.Random(8), 1_700_000_000.25, []
    for i in range(120):
        at += rng.choice([0, 0.5, 3, 20, 61, 130])
        rows.append((rng.randint(1, 6), i, dt.datetime.fromtimestamp(at, dt.UTC)))
    for n, parts in ((1, 1), (2, 4), (3, 12)):
        folder, size = f"{tmp_path}/{n}", len(rows) // parts
        for p in range(parts):
            spark.createDataFrame(rows[p * size : (p + 1) * size], SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        got = sorted(tuple(r) for r in replayed_silences(spark, folder, SCHEMA, "user_id", "event_id", "ts", 60, 300, glob="*.parquet", files=1).collect())
        want, end = [], int(rows[-1][2].timestamp())
        for user in range(1, 7):
            own = [(e, int(t.timestamp())) for u, e, t in rows if u == user]
            for (e, t), after in zip(own, [t for _, t in own[1:]] + [end]):
                want += [(str(user), e, a) for s, a in ((60, "soft_timeout"), (300, "hard_timeout")) if after - t >= s]
        assert got == sorted(want), (n, set(got) ^ set(want))
