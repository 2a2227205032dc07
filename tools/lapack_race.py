"""Show the first-use race of pure-Java LAPACK's machine constants.

Starts a fresh local session and lets many tasks make their first call
to ``Dlamch.dlamch('S')`` (the safe minimum) at the same moment through
Spark SQL's ``reflect``.  With the race, different tasks see different
values, and the JVM may keep a wrong one.  The correct value is
2.2250738585072014E-308.  Run it a few times: each run is a fresh JVM.

    python tools/lapack_race.py
"""

from pyspark.sql import SparkSession


def main() -> None:
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    q = "reflect('org.netlib.lapack.Dlamch', 'dlamch', 'S') AS s"
    first = sorted({r.s for r in spark.range(0, 32, numPartitions=32).selectExpr(q).collect()})
    after = sorted({r.s for r in spark.range(0, 32, numPartitions=32).selectExpr(q).collect()})
    print({"first_calls": first, "later_calls": after})
    spark.stop()


if __name__ == "__main__":
    main()
