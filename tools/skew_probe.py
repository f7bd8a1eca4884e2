"""Hot-key probe: one key holds a third of the rows.

Derives a larger input from the events table (each event repeated ``REP``
times with a distinct id), sends every third row to one key, and times
(a) the chunked scan and (b) a plain ``Window.partitionBy(key)`` running
count, both fully executed with the noop sink.  Prints one JSON line.

usage: python tools/skew_probe.py [sf_dir] [rep] [max_chunk_rows]
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from eventide.functions import scan  # noqa: E402
from eventide.session import get_session  # noqa: E402
from eventide.sources.tables import read_table  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    rep = int(sys.argv[2]) if len(sys.argv) > 2 else 20
    chunk = int(sys.argv[3]) if len(sys.argv) > 3 else 100_000
    spark = get_session("local[8]", shuffle_partitions=16, checkpoint_dir=tempfile.mkdtemp(prefix="skew-"))
    e = read_table(spark, sf, "events", "event_id", "ts", "user_id", "value")
    big = (e.withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(rep - 1))))
             .select((F.col("event_id") * rep + F.col("r")).alias("id"), "ts", "value",
                     F.when(F.pmod(F.col("event_id") * rep + F.col("r"), F.lit(3)) == 0, F.lit("hot"))
                      .otherwise(F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("k")))
    big = big.repartition(16)
    times = {}

    def run(name, df):
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)

    run("warmup_scan", big.select("k"))
    w = Window.partitionBy("k").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)
    run("plain_window", big.select("*", F.count(F.lit(1)).over(w).alias("n"), F.sum("value").over(w).alias("s")))
    run("chunked_scan", scan.running_sums(big, ["k"], ["ts", "id"],
                                          {"n": F.lit(1).cast("long"), "s": "value"}, max_chunk_rows=chunk))
    from eventide import schemas as S
    reqs = big.withColumn("requested_status", F.element_at(
        F.array(*[F.lit(x) for x in S.ORDER_STATUSES]), (F.pmod(F.col("id"), F.lit(7)) + 1).cast("int")))
    run("state_fold", scan.fold_states(reqs, ["k"], ["ts", "id"], "requested_status", S.ORDER_STATUSES,
                                       S.VALID_TRANSITIONS, S.INITIAL_STATUS, "prev", max_chunk_rows=chunk))
    rows = big.count()
    print(json.dumps({"rows": rows, "hot_rows": rows // 3, "max_chunk_rows": chunk, "sec": times}))


if __name__ == "__main__":
    main()
