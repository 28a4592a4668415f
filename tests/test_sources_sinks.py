"""Export readers (S1-S11), bronze hashing (G4), writes (K1-K6) and incremental silver."""
import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake.plans import bronze, silver
from ledgerlake.sinks.writers import export_counts, export_gold, plan_write, write_bronze
from ledgerlake.sources import exports
from ledgerlake.streaming.incremental import start_incremental_silver


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return path


CHASE = ("Transaction Date,Post Date,Description,Category,Type,Amount\n"
         "01/05/2026,01/06/2026,COFFEE,Food & Drink,Sale,-3.50\n"
         "01/05/2026,01/06/2026,COFFEE,Food & Drink,Sale,-3.50\n"
         "01/07/2026,01/08/2026,PAYMENT THANK YOU,,Payment,500.00\n"
         "\n"
         "01/09/2026,01/09/2026,\"BOOKS, USED\",Shopping,Sale,-12.25\n")


def test_chase_reader_flips_sign_and_labels_account(spark, tmp_dir):
    p = write(f"{tmp_dir}/chase/a.b_c.csv", CHASE)
    df = exports.read_source(spark, "chase", p)
    rows = sorted(df.collect(), key=lambda r: r.pos)
    assert [r.amount for r in rows] == [3.5, 3.5, -500.0, 12.25]
    assert rows[0].source_account_hint == "a.b"
    assert rows[3].description == "BOOKS, USED"
    assert rows[2].category_raw is None
    assert rows[0].transaction_date == dt.date(2026, 1, 5)


def test_amex_skips_preamble_and_passes_extra_columns(spark, tmp_dir):
    pre = "".join(f"preamble {i}\n" for i in range(5)) + "\n"
    body = ("Date,Description,Card Member,Account #,Amount,Category\n"
            "02/01/2026,GROCER,J DOE,-1001,45.10,Groceries\n"
            "02/03/2026,REFUND,J DOE,-1001,-5.00,\n")
    p = write(f"{tmp_dir}/amex/plain.csv", pre + body)
    df = exports.read_source(spark, "amex", p)
    assert "Card Member" in df.columns and "Account #" in df.columns
    rows = sorted(df.collect(), key=lambda r: r.pos)
    assert [r.amount for r in rows] == [45.10, -5.0]
    assert rows[0].source_account_hint == "plain"


def test_fidelity_head_foot_counts_include_blank_lines(spark, tmp_dir):
    head = "Brokerage export\n\n"
    grid = ("Run Date,Account,Action,Symbol,Description,Currency,Price,Quantity,Amount\n"
            "03/02/2026, X1 ,YOU BOUGHT ABC, ABC ,ABC INC,USD,10.5,3,-31.50\n"
            "03/03/2026,X1,YOU SOLD ABC,ABC,ABC INC,USD,$11,1,11.00\n")
    foot = "".join(f"footer {i}\n" for i in range(10)) + "\n"
    p = write(f"{tmp_dir}/fid/fidelity_2026.csv", head + grid + foot)
    df = exports.read_source(spark, "fidelity", p)
    rows = sorted(df.collect(), key=lambda r: r.pos)
    assert len(rows) == 2
    assert rows[0].account == "X1" and rows[0].symbol == "ABC"
    assert rows[1].price is None  # '$11' is no number
    assert set(df.columns) >= {"trade_date", "currency", "source", "ingested_at"}


def test_vanguard_missing_columns_fail_with_list(spark, tmp_dir):
    pre = "".join(f"line {i}\n" for i in range(21))
    p = write(f"{tmp_dir}/van/v_1.csv", pre + "Trade Date,Symbol\n03/02/2026,VTI\n")
    with pytest.raises(exports.MissingColumnsError, match="Account Number"):
        exports.read_source(spark, "vanguard", p)


def test_vanguard_reader(spark, tmp_dir):
    pre = "".join(f"line {i}\n" for i in range(21))
    grid = ("Trade Date,Account Number,Transaction Description,Symbol,Shares,Share Price,"
            "Net Amount,Extra\n03/02/2026,77,Buy,VTI,2,100,-200,x\n")
    df = exports.read_source(spark, "vanguard", write(f"{tmp_dir}/van/v_2.csv", pre + grid))
    r = df.collect()[0]
    assert (r.account, r.action, r.quantity, r.price, r.amount, r.currency) == \
        ("77", "Buy", 2.0, 100.0, -200.0, "USD")


def test_wide_prices_both_layouts_and_watchlist(spark, tmp_dir):
    wide = spark.createDataFrame(
        [("2026-01-02", 1.0, 2.0, 0.5, 1.5, 1.4, 100, 5.0, 6.0, 4.0, None, None, 7)],
        "Date string, `AAA Open` double, `AAA High` double, `AAA Low` double, "
        "`AAA Close` double, `AAA Adj Close` double, `AAA Volume` bigint, `BBB Open` double, "
        "`BBB High` double, `BBB Low` double, `BBB Close` double, `BBB Adj Close` double, "
        "`BBB Volume` bigint")
    out = exports.normalize_prices(wide).collect()
    assert [(r.symbol, r.close, r.volume) for r in out] == [("AAA", 1.5, 100)]  # BBB: no close
    single = spark.createDataFrame([("2026-01-02", 1.0, 2.0, 0.5, 1.5, 1.4, 9)],
                                   "Date string, Open double, High double, Low double, "
                                   "Close double, `Adj Close` double, Volume bigint")
    assert exports.normalize_prices(single, ticker="ZZZ").collect()[0].symbol == "ZZZ"
    p = write(f"{tmp_dir}/watchlist.txt", "nvda\n\n# ignored\n  coin \nNVDA\n")
    assert sorted(r.symbol for r in exports.read_watchlist(spark, p).collect()) == ["COIN", "NVDA"]
    assert exports.read_watchlist(spark, f"{tmp_dir}/absent.txt").count() == 0


def test_missing_dataset_reads_empty(spark, tmp_dir):
    df = exports.read_parquet_or_empty(spark, f"{tmp_dir}/nope", "symbol string")
    assert df.count() == 0 and df.columns == ["symbol"]


def bank_rows(spark, rows, file="card_2026.csv", at="2026-01-05 13:00:00"):
    df = spark.createDataFrame(
        [(d, desc, amt, cat, "card", "amex", file, pos, dt.datetime.fromisoformat(at))
         for pos, (d, desc, amt, cat) in enumerate(rows)],
        "transaction_date date, description string, amount double, category_raw string, "
        "source_account_hint string, source string, source_file string, pos bigint, "
        "ingested_at timestamp")
    return bronze.bronze_bank(df.drop("source_account_hint"))


def test_row_hash_occurrence_and_dedup(spark):
    d = dt.date(2026, 1, 5)
    rows = [(d, "COFFEE", 3.5, None), (d, "COFFEE", 3.5, None), (d, None, 1.0, None)]
    first = bank_rows(spark, rows)
    again = bank_rows(spark, rows, file="card_2026_redownload.csv", at="2026-01-06 13:00:00")
    hashes = [r.row_hash for r in first.collect()]
    assert len(set(hashes)) == 3          # repeats in one file stay distinct; NULL part is stable
    both = first.unionByName(again)
    stg = silver.stg_transactions(both)
    assert stg.count() == 3
    assert sorted(r.row_hash for r in stg.collect()) == sorted(hashes)
    twice = silver.stg_transactions(both.unionByName(both))  # idempotent
    assert sorted(map(repr, twice.collect())) == sorted(map(repr, stg.collect()))


def test_dedup_keeps_earliest_ingested(spark):
    d = dt.date(2026, 1, 5)
    late = bank_rows(spark, [(d, "X", 1.0, "late")], at="2026-02-01 00:00:00")
    early = bank_rows(spark, [(d, "X", 1.0, "early")], file="other_2026.csv")
    out = silver.stg_transactions(late.unionByName(early)).collect()
    assert [r.category_raw for r in out] == ["early"]


def test_bronze_write_dynamic_overwrite_and_plan(spark, tmp_dir):
    d1, d2 = dt.date(2026, 1, 5), dt.date(2026, 2, 5)
    b = bank_rows(spark, [(d1, "A", 1.0, None), (d2, "B", 2.0, None)])
    assert sorted((r.source, r.year_month, r.rows) for r in plan_write(b).collect()) == \
        [("amex", "2026-01", 1), ("amex", "2026-02", 1)]
    path = f"{tmp_dir}/bronze/bank"
    write_bronze(b, path)
    write_bronze(bank_rows(spark, [(d2, "C", 3.0, None), (d2, "D", 4.0, None)]), path)
    back = spark.read.parquet(path)
    got = sorted((r.year_month, r.description) for r in back.collect())
    assert got == [("2026-01", "A"), ("2026-02", "C"), ("2026-02", "D")]


def test_export_gold_counts(spark, tmp_dir):
    t = {"a": spark.range(3).toDF("x"), "b": None}
    out = export_gold(spark, t, f"{tmp_dir}/gold")
    assert {r.table_name: r.rows for r in export_counts(out).collect()} == {"a": 3}


@pytest.mark.parametrize("ttl", [None, "30 days"])
def test_incremental_silver_stream(spark, tmp_dir, ttl):
    d = dt.date(2026, 1, 5)
    bronze_path, silver_path = f"{tmp_dir}/bronze", f"{tmp_dir}/silver"
    ckpt = f"{tmp_dir}/ckpt"
    b1 = bank_rows(spark, [(d, "A", 1.0, None), (d, "B", 2.0, None)])
    write_bronze(b1.drop("row_bucket"), bronze_path, mode="append")
    q = start_incremental_silver(spark, "stg_transactions", bronze_path, silver_path, ckpt,
                                 state_ttl=ttl)
    q.awaitTermination()
    b2 = bank_rows(spark, [(d, "A", 1.0, None), (d, "C", 3.0, None)], file="x_2026.csv",
                   at="2026-01-07 00:00:00")
    write_bronze(b2.drop("row_bucket"), bronze_path, mode="append")
    q = start_incremental_silver(spark, "stg_transactions", bronze_path, silver_path, ckpt,
                                 state_ttl=ttl)
    q.awaitTermination()
    out = spark.read.parquet(silver_path)
    assert sorted(r.description for r in out.collect()) == ["A", "B", "C"]
    assert out.schema["amount"].dataType.simpleString() == "decimal(18,2)"
    assert out.filter(F.col("description") == "A").collect()[0].amount == Decimal("1.00")


def test_occurrences_of_a_long_run(spark):
    d = dt.date(2026, 1, 5)
    b = bank_rows(spark, [(d, "COFFEE", 3.5, None)] * 40 + [(d, "TEA", 2.0, None)] * 7)
    assert b.select("row_hash").distinct().count() == 47


def test_quoted_line_break_is_one_record(spark, tmp_dir):
    p = write(f"{tmp_dir}/chase/q_1.csv", CHASE + '01/10/2026,01/10/2026,"TWO\nLINES",,Sale,-1\n')
    rows = exports.read_source(spark, "chase", p).orderBy("pos").collect()
    assert [r.description for r in rows][3:] == ["BOOKS, USED", "TWO\nLINES"]


def test_gate_stops_before_anything_is_written(spark, tmp_dir):
    from ledgerlake.plans.gate import BatchRejected, ingest_export, ingest_prices
    bad = write(f"{tmp_dir}/chase/bad_1.csv", CHASE.replace("-12.25", '"$1,234.50"'))
    with pytest.raises(BatchRejected, match="numeric amount: 1 rows"):
        ingest_export(spark, "chase", bad, f"{tmp_dir}/lake/bank")
    assert not os.path.exists(f"{tmp_dir}/lake/bank")
    good = write(f"{tmp_dir}/chase/good_1.csv", CHASE)
    assert ingest_export(spark, "chase", good, f"{tmp_dir}/lake/bank") == []
    back = spark.read.parquet(f"{tmp_dir}/lake/bank")
    assert back.count() == 4 and {"source", "year_month", "row_hash"} <= set(back.columns)
    wide = spark.createDataFrame([("2026-01-02", 1.5, 7), ("bad day", 1.5, 7), ("2026-01-03", None, 1)],
                                 "Date string, `AAA Close` double, `AAA Volume` bigint")
    ingest_prices(wide, f"{tmp_dir}/lake/prices", "grid.csv")
    px = spark.read.parquet(f"{tmp_dir}/lake/prices").collect()
    assert {(r.source, r.source_file) for r in px} == {("stock_prices", "grid.csv")}
    empty = write(f"{tmp_dir}/chase/none_1.csv", CHASE.split("\n")[0] + "\n")
    with pytest.raises(BatchRejected, match="non_empty"):
        ingest_export(spark, "chase", empty, f"{tmp_dir}/lake/none")


def test_damage_is_found_by_every_rule(spark):
    from ledgerlake.catalog import QUERIES
    from ledgerlake.operators.quality import INGEST_RULES
    out = QUERIES["damaged_ingest_report"](spark, "/root/testdata/sf0.001").collect()
    found = {(r.rule, r.column_name) for r in out if r.failing_rows > 0}
    assert found == {(x.kind, x.column) for rules in INGEST_RULES.values() for x in rules}


def test_refresh_window(spark):
    from ledgerlake.plans.ingest import backfill_window
    trades = spark.createDataFrame([(dt.date(2026, 1, 9),), (dt.date(2026, 1, 2),), (None,)],
                                   "trade_date date")

    def window(**kw):
        return tuple(backfill_window(trades, end="2026-02-01", **kw).first())
    end = dt.date(2026, 2, 1)
    assert window(backfill=True) == (dt.date(2026, 1, 2), end)
    assert window(start="2026-01-15", backfill=True) == (dt.date(2026, 1, 15), end)
    assert window() == (dt.date(2026, 1, 27), end)
    assert backfill_window(trades.limit(0), end="2026-02-01", backfill=True).first()[0] is None


def test_tables_of_the_catalog(spark, tmp_dir):
    from ledgerlake.sinks.writers import tables_from_catalog
    spark.range(4).createOrReplaceTempView("made")
    found = tables_from_catalog(spark, ["made", "absent"])
    assert found["made"].count() == 4 and found["absent"] is None


def test_scratch_folders_are_released(spark):
    from ledgerlake.session import materialize, release_scratch
    df = materialize(spark.range(3), "tested")
    path = df.inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path)
    assert release_scratch(spark) >= 1 and not os.path.exists(path)


def test_more_date_layouts(spark):
    texts = ["01/05/2026", "1/5/26", "2026-01-05", "2026/01/05", "20260105", "5-Jan-2026",
             "Jan 5, 2026", "January 5, 2026", "2026-01-05 10:11:12", "nonsense"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(exports.parse_date("t")).collect()]
    assert got == [dt.date(2026, 1, 5)] * 9 + [None]


def test_queries_are_built_without_a_job(spark):
    from ledgerlake.catalog import QUERIES
    writes = {"gold_export_counts", "gold_export_contents", "quality_report", "source_roundtrip",
              "fidelity_roundtrip", "vanguard_roundtrip", "lake_trades", "lake_prices",
              "watchlist_file", "materialised_spending", "running_cost_stream",
              "incremental_silver", "incremental_spending", "incremental_wealth",
              "publish_report", "header_audit", "uneven_roundtrip", "two_generations",
              "catalog_lots"}
    tracker = spark.sparkContext.statusTracker()
    for name in sorted(set(QUERIES) - writes):
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        QUERIES[name](spark, "/root/testdata/sf0.001")
        # Listing and schema inference of a parquet file are the only jobs.
        own = [j for j in tracker.getJobIdsForGroup(f"build-{name}")
               if (i := tracker.getJobInfo(j)) and len(i.stageIds) > 1]
        assert not own, name
    spark.sparkContext.setJobGroup("", "")


def test_plans_read_the_ledger_once(spark):
    from ledgerlake.catalog import QUERIES
    for name, folds, scans in (("portfolio_roe_summary", 1, 2), ("investment_growth", 1, 2),
                               ("backfill_bounds", 0, 1)):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution() \
            .optimizedPlan().toString()
        assert plan.count("_fold_partition") == folds, (name, plan)
        assert plan.count("Relation [") == scans, (name, plan)


def test_read_bronze_partitions_and_missing_columns(spark, tmp_dir):
    from ledgerlake.sources.lake import read_bronze
    d1 = dt.date(2026, 1, 5)
    path = f"{tmp_dir}/bronze/bank2"
    write_bronze(bank_rows(spark, [(d1, "A", 1.0, None)]).drop("category_raw"), path)
    schema = ("transaction_date date, description string, amount double, category_raw string, "
              "row_hash string, source string, year_month string")
    df = read_bronze(spark, path, schema)
    r = df.filter(F.col("year_month") == "2026-01").collect()
    assert len(r) == 1 and r[0].source == "amex" and r[0].category_raw is None
    assert read_bronze(spark, path, schema, recursive=True).count() == 1
    assert read_bronze(spark, f"{tmp_dir}/absent", schema).count() == 0


def test_presentation_orders(spark):
    from ledgerlake.plans.present import present
    df = spark.createDataFrame([("vanguard", 1.0), ("ALL", 2.0), ("fidelity", None)],
                               "source string, total_gain double")
    assert [r.source for r in present("portfolio_roe_summary", df).collect()] == \
        ["ALL", "fidelity", "vanguard"]
    assert [r.source for r in present("investment_growth", df).collect()] == \
        ["ALL", "vanguard", "fidelity"]


def test_files_with_different_layouts_read_together(spark, tmp_dir):
    a = write(f"{tmp_dir}/mix/one_2026.csv", CHASE)
    b = write(f"{tmp_dir}/mix/two_2026.csv",
              "Amount,Type,Category,Description,Post Date,Transaction Date\n"
              "-8.00,Sale,Gas,FUEL,02/02/2026,02/01/2026\n")
    df = exports.read_source(spark, "chase", [a, b])
    rows = {(r.source_account_hint, r.description): r for r in df.collect()}
    assert len(df.collect()) == 5
    fuel = rows[("two", "FUEL")]
    assert (fuel.amount, fuel.category_raw, fuel.transaction_date) == \
        (8.0, "Gas", dt.date(2026, 2, 1))


def test_order_of_day_and_month_is_the_files(spark, tmp_dir):
    head = "Transaction Date,Description,Category,Amount\n"
    write(f"{tmp_dir}/m/us_1.csv", head + "03/04/2024,A,,-1\n03/14/2024,B,,-1\n")
    write(f"{tmp_dir}/m/eu_1.csv", head + "03/04/2024,C,,-1\n14/03/2024,D,,-1\n,E,,-1\n")
    write(f"{tmp_dir}/m/short_1.csv", head + "03/04/97,F,,-1\n")
    write(f"{tmp_dir}/m/both_1.csv", head + "14/03/2024,G,,-1\n03/14/2024,H,,-1\n")
    write(f"{tmp_dir}/m/dots_1.csv", head + "31.12.99,I,,-1\n")
    df = exports.read_source(spark, "chase", f"{tmp_dir}/m")
    got = {r.description: r.transaction_date for r in df.collect()}
    d = dt.date
    assert got == {"A": d(2024, 3, 4), "B": d(2024, 3, 14), "C": d(2024, 4, 3),
                   "D": d(2024, 3, 14), "E": None, "F": d(1997, 3, 4), "G": None,
                   "H": d(2024, 3, 14), "I": d(1999, 12, 31)}
    audit = exports.header_audit(spark, f"{tmp_dir}/m", required=exports.CHASE_COLUMNS).collect()
    assert {r.source_file: r.date_order["Transaction Date"] for r in audit} == {
        "us_1.csv": "M/d", "eu_1.csv": "d/M", "short_1.csv": "ambiguous", "both_1.csv": "mixed",
        "dots_1.csv": "d/M"}


def test_audit_of_damaged_files(spark, tmp_dir):
    write(f"{tmp_dir}/a/none_1.csv", "\n")
    write(f"{tmp_dir}/a/head_1.csv", "Transaction Date,Memo\n")
    write(f"{tmp_dir}/a/good_1.csv", CHASE)
    audit = {r.source_file: r for r in exports.header_audit(
        spark, f"{tmp_dir}/a", required=exports.CHASE_COLUMNS).collect()}
    assert audit["none_1.csv"].found is None
    assert audit["none_1.csv"].missing == exports.CHASE_COLUMNS
    assert audit["head_1.csv"].missing == ["Description", "Category", "Amount"]
    assert audit["head_1.csv"].extra == ["Memo"] and audit["head_1.csv"].records == 0
    assert audit["good_1.csv"].missing == [] and audit["good_1.csv"].records == 4
    with pytest.raises(exports.MissingColumnsError, match="head_1.csv.*Description.*Memo"):
        exports.read_source(spark, "chase", f"{tmp_dir}/a")


def test_a_batch_is_evaluated_once(spark, tmp_dir):
    from ledgerlake.plans.gate import write_audit_publish
    from ledgerlake.sinks.writers import BANK_PARTITIONS
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    d = dt.date(2026, 1, 5)
    batch = bank_rows(spark, [(d, "A", 1.0, None), (d, "A", 1.0, None), (d, "B", 2.0, None)])
    batch = batch.mapInArrow(count, batch.schema)
    audit = write_audit_publish(batch, "bank_transactions", f"{tmp_dir}/lake", BANK_PARTITIONS,
                                f"{tmp_dir}/stage")
    assert seen.value == 3 and audit.written == 3 and not os.path.exists(f"{tmp_dir}/stage")
    assert spark.read.parquet(f"{tmp_dir}/lake").count() == 3
    bad = batch.withColumn("amount", F.when(F.col("description") == "A", F.col("amount")))
    audit = write_audit_publish(bad, "bank_transactions", f"{tmp_dir}/lake2", BANK_PARTITIONS)
    assert audit.errors == [("numeric", "amount", 1)] and audit.written == 0
    assert seen.value == 6 and os.listdir(tmp_dir).count("lake2") == 0


def test_observed_rules_count_like_the_check(spark):
    from ledgerlake.catalog import build
    from ledgerlake.operators import quality
    from ledgerlake.plans.roundtrips import damaged_bronze
    from pyspark.sql import Observation
    m = build(spark, "/root/testdata/sf0.001")
    for name, df in damaged_bronze(m).items():
        rules = quality.with_predicates(quality.INGEST_RULES[name])
        seen = Observation(f"test-{name}")
        df.observe(seen, *quality.observed(rules)).write.format("noop").mode("overwrite").save()
        repeats = {r.column: quality.repeats_of(df, r.column) for r in rules
                   if r.kind in quality.REPEATS}
        want = [(r.rule, r.column_name, r.severity, r.failing_rows)
                for r in quality.check(df, name, rules).collect()]
        assert quality.from_observed(rules, seen.get, repeats) == want


def test_a_published_batch_is_written_once(spark, tmp_dir, monkeypatch):
    from ledgerlake.plans import gate
    from ledgerlake.sinks.merge import Stage
    from ledgerlake.sinks.writers import BANK_PARTITIONS
    staged, move = [], Stage.move

    def seen(stage, target, partitions):
        staged.extend(f.rsplit("/", 1)[1] for f in spark.read.parquet(stage.path).inputFiles())
        move(stage, target, partitions)

    monkeypatch.setattr(Stage, "move", seen)
    path, d = f"{tmp_dir}/lake", dt.date(2026, 1, 5)
    for rows in ([(d, "A", 1.0, None), (dt.date(2026, 2, 5), "B", 2.0, None)],
                 [(d, "C", 3.0, None), (d, "D", 4.0, None)]):
        staged.clear()
        batch = bank_rows(spark, rows)
        assert gate.write_audit_publish(batch, "bank_transactions", path, BANK_PARTITIONS).written == 2
        files = {f.rsplit("/", 1)[1] for f in spark.read.parquet(path).inputFiles()}
        assert staged and files >= set(staged), "the staged files themselves"
    back = spark.read.parquet(path).collect()  # the month of the second batch is replaced
    assert sorted(r.description for r in back) == ["B", "C", "D"]
    assert os.listdir(tmp_dir) == ["lake"]


def test_damaged_batches_of_published_ones_are_the_same(spark, tmp_dir):
    from ledgerlake.catalog import build
    from ledgerlake.plans import gate, roundtrips
    m = build(spark, "/root/testdata/sf0.001")
    lake = {}
    for name in m.all_bronze():
        cols = roundtrips.TRADE_PARTITIONS if name != "stock_prices" else roundtrips.PRICE_PARTITIONS
        batch = roundtrips._audited(m, name)
        assert gate.write_audit_publish(batch, name, f"{tmp_dir}/{name}", cols).written
        lake[name] = spark.read.schema(batch.schema).parquet(f"{tmp_dir}/{name}").drop("row_bucket")
    derived = roundtrips.damaged_bronze(m)
    for name, df in roundtrips.damaged_bronze(m, lake).items():
        want = derived[name].drop("row_bucket")
        assert sorted(map(repr, df.select(*want.columns).collect())) == sorted(map(repr, want.collect()))
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan, "read, not derived"
