"""Benchmark: pipeline stages, operators and the question set on the driver tables.

Prints ONE JSON line: {"metric", "value" (sum of our timings), "unit", "queries", "sf",
"plain", "slope"}. ``plain`` times a straightforward way to the same results on the same
machine: one job for each statistic, one unpartitioned window for each key, one count around
each cleaning step, and the questions as SQL text. ``slope`` compares with the scale below:
seconds and rows of both, for entries that read the growing tables.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_REPEAT,
BENCH_SLOPE_DIR (default: the sibling folder of a tenth of the scale; empty for none).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time
from concurrent.futures import ThreadPoolExecutor

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tessera.operators import quality as QL  # noqa: E402
from tessera.operators import sketches as SK  # noqa: E402
from tessera.operators.clean import audit, first_failed, survivors_of  # noqa: E402
from tessera.operators.fact import build_fact, integrity  # noqa: E402
from tessera.plans.crimes import clean_iucr, gold_dim_builders  # noqa: E402
from tessera.operators.keys import with_ntiles, with_surrogate_key  # noqa: E402
from tessera.plans import questions as Q  # noqa: E402
from tessera.plans import tpch  # noqa: E402
from tessera.plans.star import Star  # noqa: E402
from tessera.session import get_session  # noqa: E402
from tessera.sources.catalog import data_dictionary  # noqa: E402


REPEAT = int(os.environ.get("BENCH_REPEAT", "2"))
SPARK = None


def timed(fn, repeat: int | None = None):
    """Best of ``repeat`` runs (the first run of a plan also pays JVM warm-up)."""
    best = None
    for _ in range(repeat or REPEAT):
        SPARK.catalog.clearCache()  # no run reuses data persisted by an earlier one
        t = time.perf_counter()
        fn()
        d = time.perf_counter() - t
        best = d if best is None else min(best, d)
    return round(best, 3)


def sink(df):
    """Run the plan to the end without moving rows to the driver."""
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    scratch = tempfile.mkdtemp(prefix="tessera-bench-")
    extra = {"spark.sql.warehouse.dir": f"{scratch}/wh",
             "spark.driver.memory": "16g",
             "spark.sql.files.maxPartitionBytes": str(64 << 20),
             "spark.driver.extraJavaOptions": f"-Dderby.system.home={scratch}"}
    if os.environ.get("BENCH_EVENTLOG"):
        # stage and task times for later reading, written to this run's scratch folder
        os.makedirs(f"{scratch}/events", exist_ok=True)
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"{scratch}/events"})
        print(f"event log: {scratch}/events", file=sys.stderr)
    spark = get_session(f"local[{cpus}]", app="tessera-bench", shuffle_partitions=max(8, 2 * cpus),
                        extra=extra)
    spark.sparkContext.setLogLevel("ERROR")
    spark.sparkContext.setCheckpointDir(f"{scratch}/ckpt")
    global SPARK
    SPARK = spark
    q: dict[str, float] = {}
    plain: dict[str, float] = {}

    # warm-up: JVM, parquet footers (not timed)
    sink(tpch.table(spark, sf_dir, "lineitem").groupBy("l_returnflag").count())

    # 1. cleaning with its audit (orders landing text, dedupe, rules)
    # as the pipeline does: dedupe survivors written once, partitioned by the first failed
    # rule (kept rows under null); the audit reads that table instead of deduping again
    typed = tpch.orders_typed(tpch.orders_raw(spark, sf_dir))
    spec = tpch.orders_clean_spec()
    staged_path = f"{scratch}/orders_checked"
    staged = survivors_of(typed, spec).withColumn("_reason", first_failed(spec.post))
    q["clean"] = timed(lambda: staged.write.mode("overwrite").partitionBy("_reason")
                       .parquet(staged_path))
    checked = spark.read.parquet(staged_path)
    q["clean_audit"] = timed(lambda: audit(typed, spec, survivors=checked).collect())

    # 2. silver: dedupe of line items + joins, written; gold: keyed dims + fact, written
    def written_star(name: str, occ) -> Star:
        """Dimensions side by side, then the fact against the written dimensions."""
        builders = gold_dim_builders(spark, occ, tpch.clean_indicators(tpch.indicators_raw(spark, sf_dir)),
                                     clean_iucr(tpch.codes_raw(spark, sf_dir)))
        base = f"{scratch}/{name}"
        with ThreadPoolExecutor(max_workers=len(builders)) as ex:
            list(ex.map(lambda n: builders[n]().write.mode("overwrite").parquet(f"{base}/{n}"), builders))
        back = {n: spark.read.parquet(f"{base}/{n}") for n in builders}
        build_fact(occ, type_dim=back["dim_crime_type"], location_dim=back["dim_location"],
                   area_dim=back["dim_community_area"]).write.mode("overwrite").parquet(f"{base}/fact_crime")
        t = {n: spark.read.parquet(f"{base}/{n}") for n in Star.TABLES}
        return Star(fact=t["fact_crime"], dim_date=t["dim_date"], dim_time=t["dim_time"], dim_type=t["dim_crime_type"],
                    dim_area=t["dim_community_area"], dim_location=t["dim_location"])

    silver = f"{scratch}/silver"
    q["silver_build"] = timed(lambda: tpch.line_occurrences(spark, sf_dir).write.mode("overwrite").parquet(silver))
    occ = spark.read.parquet(silver)
    q["gold_build"] = timed(lambda: written_star("gold", occ))
    star = written_star("gold", occ)
    events = written_star("events", tpch.event_occurrences(spark, sf_dir))

    # 3. keys over as many members as there are orders, tiles over customers
    orders = tpch.table(spark, sf_dir, "orders").select("o_orderkey")
    customers = tpch.table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    q["surrogate_key"] = timed(lambda: sink(with_surrogate_key(orders, ["o_orderkey"], "k", key_type="long")))
    q["ntile"] = timed(lambda: sink(with_ntiles(customers, {"t": (10, ["c_acctbal", "c_custkey"])})))

    # 4. quality
    lines = tpch.table(spark, sf_dir, "lineitem")
    socio = tpch.clean_indicators(tpch.indicators_raw(spark, sf_dir))
    fks = {"date_key": (star.dim_date, "date_key"), "time_key": (star.dim_time, "time_key"),
           "crime_type_key": (star.dim_type, "crime_type_key"),
           "community_area_key": (star.dim_area, "community_area_key"), "location_key": (star.dim_location, "location_key")}
    domains = ["beat", "district", "ward", "community_area", "year", "latitude", "longitude"]
    unknown = [QL.Check("fact", k, "", "", "fact", F.col(k) == -1) for k in ("community_area_key", "location_key", "crime_type_key")]
    for name, fn in {
            "profile": lambda: QL.profile(occ), "dup_keys": lambda: QL.duplicate_keys(lines, tpch.LINE_KEYS),
            "numeric_domains": lambda: QL.numeric_domains(occ, domains),
            "value_counts": lambda: QL.value_counts(occ, "location_description", 15),
            "column_sketches": lambda: SK.column_sketches(occ), "frequent_values": lambda: SK.frequent_values(occ, "primary_type", 15),
            "orphans": lambda: QL.coverage(occ, socio, "community_area"),
            "star_integrity": lambda: integrity(star.fact, fks),
            "quality_report": lambda: QL.quality_report({"fact": star.fact}, unknown),
            "data_dictionary": lambda: data_dictionary(tpch.table(spark, sf_dir, "part"), "part")}.items():
        q[name] = timed(lambda fn=fn: fn().collect())

    # 5. the question set over the written stars (hours and weekdays over the events); the
    # first run of each, with planning and compilation, is kept as well
    questions = {"bq1": (Q.bq1, star), "bq2": (Q.bq2, star), "bq3a": (Q.bq3a, events), "bq3b": (Q.bq3b, events),
                 "bq3c": (Q.bq3c, events), "bq4a": (Q.bq4a, star), "bq4b": (Q.bq4b, star), "bq5": (Q.bq5, star),
                 "bq6a": (Q.bq6a, star), "bq6b": (Q.bq6b, star), "bq7": (Q.bq7, star), "rate_extremes": (Q.rate_extremes, star)}
    first: dict[str, float] = {}
    for name, (fn, s) in questions.items():
        first[name] = timed(lambda: fn(s).collect(), 1)
        q[name] = timed(lambda: fn(s).collect())
    mart_dir = f"{scratch}/marts"

    def write_marts():
        made = Q.marts(star, events, before_year=2001)
        with ThreadPoolExecutor(max_workers=len(made)) as ex:
            list(ex.map(lambda n: made[n].write.mode("overwrite").parquet(f"{mart_dir}/{n}"), made))
    q["marts_build"] = timed(write_marts)
    written = {f"mart_bq{i}": spark.read.parquet(f"{mart_dir}/mart_bq{i}") for i in range(1, 8)}
    q["widget_series"] = timed(lambda: Q.widget_all(written).collect())

    def refresh():  # a dashboard refresh: all questions submitted together (wall clock)
        with ThreadPoolExecutor(max_workers=len(questions)) as ex:
            list(ex.map(lambda f: f[0](f[1]).collect(), questions.values()))
    q["questions_concurrent"] = timed(refresh)

    # ---- a plain way to the same results ------------------------------------------------------
    def statistic_by_statistic():
        """The profile's numbers, each by a job of its own."""
        return [occ.count()] + [job() for c in occ.columns for job in (
            occ.where(F.col(c).isNull()).count, occ.select(c).distinct().count)]

    def ranked_at_once(df, order, out, n=None):
        w = Window.orderBy(*order)
        return df.withColumn(out, F.row_number().over(w) if n is None else F.ntile(n).over(w))

    def counted_steps():
        """The cleaning rules with a count of the rows before and after each."""
        rows, n = typed, [typed.count()]
        for rule in (*spec.pre, *spec.post):
            rows = rows.where(rule.keep)
            n.append(rows.count())
        sink(rows.dropDuplicates(["id"]))
        return n

    plain["profile"] = timed(statistic_by_statistic)
    plain["clean"] = timed(counted_steps)
    plain["surrogate_key"] = timed(lambda: sink(ranked_at_once(orders, ["o_orderkey"], "k")))
    plain["ntile"] = timed(lambda: sink(ranked_at_once(customers, ["c_acctbal", "c_custkey"], "t", 10)))
    views = ("fact", "dim_date", "dim_time", "dim_type", "dim_area")
    for prefix, s in (("", star), ("ev_", events)):
        for v in views:
            getattr(s, v).createOrReplaceTempView(prefix + v)
    pct = "round(100.0 * avg(CASE WHEN is_arrest THEN 1 ELSE 0 END), 1)"
    area = "FROM fact JOIN dim_area USING (community_area_key) WHERE community_area_key > 0"
    statements = {
        "bq1": f"SELECT primary_type, count(*) n, {pct} FROM fact JOIN dim_type USING (crime_type_key) GROUP BY 1 ORDER BY n DESC LIMIT 20",
        "bq2": f"SELECT is_domestic, count(*), {pct} FROM fact GROUP BY 1",
        "bq3a": f"SELECT shift, count(*) n, {pct} FROM ev_fact JOIN ev_dim_time USING (time_key) GROUP BY 1 ORDER BY n DESC",
        "bq3b": f"SELECT day_of_week, count(*) n, {pct} FROM ev_fact JOIN ev_dim_date USING (date_key) GROUP BY 1 ORDER BY n DESC",
        "bq3c": f"SELECT time_key, count(*), {pct} FROM ev_fact GROUP BY 1 ORDER BY 1",
        "bq4a": f"SELECT year, count(*), {pct} FROM fact JOIN dim_date USING (date_key) GROUP BY 1 ORDER BY 1",
        "bq4b": "SELECT month, month_name, count(*) FROM fact JOIN dim_date USING (date_key) GROUP BY 1, 2 ORDER BY 1",
        "bq5": f"SELECT community_area, community_area_name, count(*) n {area} GROUP BY 1, 2 ORDER BY n DESC LIMIT 15",
        "bq6a": f"SELECT hardship_quartile, count(*), round(avg(per_capita_income)), {pct} {area} GROUP BY 1 ORDER BY 1",
        "bq6b": "SELECT corr(n, per_capita_income), corr(n, hardship_index), corr(n, pct_below_poverty) FROM dim_area JOIN "
                "(SELECT community_area_key, count(*) n FROM fact WHERE community_area_key > 0 GROUP BY 1) USING (community_area_key)",
        "bq7": f"SELECT is_index, count(*) n, 100 * count(*) / sum(count(*)) OVER (), {pct} FROM fact JOIN dim_type USING (crime_type_key) GROUP BY 1"}
    plain_first = {n: timed(lambda: spark.sql(t).collect(), 1) for n, t in statements.items()}
    plain["questions_sql"] = round(sum(timed(lambda: spark.sql(t).collect()) for t in statements.values()), 3)
    plain["questions_sql_first_run"] = round(sum(plain_first.values()), 3)
    q["questions_total"] = round(sum(q[n] for n in statements), 3)
    q["questions_first_run"] = round(sum(first[n] for n in statements), 3)

    # ---- the same entries a scale below ---------------------------------------------------------
    slope = {}
    small = os.environ.get("BENCH_SLOPE_DIR", re.sub(r"sf0\.1$", "sf0.01", sf_dir))
    if small and small != sf_dir and os.path.isdir(small):
        def at(d):
            t, o = tpch.table(spark, d, "lineitem"), tpch.table(spark, d, "orders").select("o_orderkey")
            return {"dup_keys": lambda: QL.duplicate_keys(t, tpch.LINE_KEYS).collect(), "profile": lambda: QL.profile(t).collect(),
                    "silver": lambda: sink(tpch.line_occurrences(spark, d)),
                    "surrogate_key": lambda: sink(with_surrogate_key(o, ["o_orderkey"], "k", key_type="long"))}, t.count()
        (low, n_low), (high, n_high) = at(small), at(sf_dir)
        slope = {"rows": [n_low, n_high], **{n: [timed(low[n]), timed(high[n])] for n in low}}

    sf = re.search(r"sf([0-9.]+)", sf_dir)
    total = sum(v for k, v in q.items()
                if k not in ("questions_total", "questions_first_run", "questions_concurrent"))  # no double counting
    out = {"metric": "total_sec", "value": round(total, 3), "unit": "sec", "queries": q,
           "sf": float(sf.group(1)) if sf else sf_dir, "cpus": cpus,
           "timing": f"best of {REPEAT} runs per entry, after a warm-up scan",
           "plain": plain, "slope": slope}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
