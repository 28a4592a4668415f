"""Shapes of plans that keep the shuffled bytes of the finance marts in bounds."""
import pytest
from pyspark.sql import functions as F

from ledgerlake.catalog import QUERIES, build
from ledgerlake.functions.hashing import packed, unpacked

SF = "/root/testdata/sf0.001"


def exchanges(df):
    df.collect()  # adaptive plans are final then
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]


@pytest.mark.parametrize("name,most", [("stg_transactions_dedup", 1), ("stg_trades_dedup", 1),
                                       ("position_lots", 2)])
def test_rows_are_shuffled_once_up_to_silver(spark, name, most):
    assert len(exchanges(QUERIES[name](spark, SF))) == most


def test_bronze_without_the_hash_has_no_exchange_of_rows(spark):
    rows = build(spark, SF).bronze("trades").select("trade_date")
    assert exchanges(rows) == []


def test_packed_hashes_come_back(spark):
    texts = [None, "", "ab", "AB", "abc", "0f" * 32, "xyz", "∅", " ab", "h1"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, h string")
    back = df.select("i", *packed("h")).select("i", unpacked("h").alias("h")).orderBy("i")
    assert [r.h for r in back.collect()] == texts
    assert df.select(packed("h")[0]).filter(F.octet_length("_h_bytes") == 32).count() == 1


def test_asof_without_buckets_is_the_same(spark):
    from ledgerlake.operators.asof import asof_join
    left = spark.sql("""SELECT if(id % 9 = 0, NULL, concat('S', id % 4)) AS k,
        if(id % 11 = 0, NULL, date_add(DATE'2020-01-01', cast(id * 7 % 200 AS int))) AS d, id
        FROM range(300)""")
    right = spark.sql("""SELECT if(id % 8 = 0, NULL, concat('S', id % 5)) AS k,
        if(id % 13 = 0, NULL, date_add(DATE'2020-01-01', cast(id * 17 % 200 AS int))) AS at,
        if(id % 6 = 0, NULL, id) AS v, id % 3 AS o FROM range(60)""")
    args = (left, right, ["k"], "d", "at", ["v"])
    cut, whole = (asof_join(*args, right_order=["o", "v"], **kw) for kw in ({}, {"bucket": None}))
    assert whole.columns == ["k", "d", "id", "v"] and whole.dtypes == cut.dtypes
    assert sorted(map(tuple, whole.collect()), key=repr) == sorted(map(tuple, cut.collect()),
                                                                   key=repr)


def test_holdings_and_prices_meet_in_one_exchange(spark):
    # trades, net days, holdings, prices (grouped, then dealt), as-of.
    assert len(exchanges(QUERIES["holdings_asof"](spark, SF))) <= 6


def test_written_hashes_and_shuffled_hashes_are_packed(spark, tmp_path):
    import glob
    from ledgerlake.operators import quality
    from ledgerlake.session import materialize, scratch_path
    from ledgerlake.sinks.writers import write_bronze
    df = spark.createDataFrame([("0f" * 32, "2020-01"), ("0f" * 32, "2020-01"),
                                ("h1", "2020-01"), ("h1", "2020-01"), ("h1", "2020-02"),
                                (None, "2020-01"), (None, "2020-01"), ("x", None)],
                               "row_hash string, year_month string")
    write_bronze(df, str(tmp_path / "b"), ["year_month"])
    assert glob.glob(str(tmp_path / "b/*/*.zstd.parquet"))
    back = materialize(df, "packed-test")
    assert quality.repeats_of(back, "row_hash") == (2, 4)
    out = quality.check(back, "t", [quality.Rule("unique", "row_hash"),
                                    quality.Rule("not_null", "row_hash"),
                                    quality.Rule("duplicates", "row_hash")])
    assert [r.failing_rows for r in out.collect()] == [2, 2, 4]
    assert not [x for x in exchanges(out) if "(row_hash" in x]


def test_a_short_ledger_costs_one_read_and_one_write_of_state(spark):
    import json
    from ledgerlake.streaming import running_cost as rc

    class Value:
        text, calls = None, 0

        def get(self):
            self.calls += 1
            return self.text

        def update(self, value):
            self.calls, self.text = self.calls + 1, value

    class Map(dict):
        def getValue(self, key):
            return self[key]

        def updateValue(self, key, value):
            self[key] = value

    def rows(days):
        return [dict(zip(rc.FIELDS, (__import__("datetime").date.fromordinal(d), -d, f"h{d}", "a",
                                     "YOU BOUGHT", 10 ** 6, 10 ** 4, True, False, False)),
                     symbol="S", source="x") for d in days]

    p = rc.RunningCost()
    p.index, p.trades = Value(), Map()
    assert len(list(p.handleInputRows(("k",), iter(rows(range(700000, 700200))), None))) == 200
    assert p.index.calls == 2 and not p.trades
    late = list(p.handleInputRows(("k",), iter(rows([699990])), None))
    assert [r.rn for r in late] == list(range(1, 202)) and p.index.calls == 4 and not p.trades
    assert not list(p.handleInputRows(("k",), iter(rows([699990])), None))  # delivered again
    more = list(p.handleInputRows(("k",), iter(rows(range(700200, 700900))), None))
    assert more[-1].rn == 901 and len(p.trades) == len(json.loads(json.loads(p.index.text[0])[0])) > 1
    last = list(p.handleInputRows(("k",), iter(rows([701000])), None))
    assert last[-1].rn == 902 and last[-1]._s == 902 * 10 ** 6


def test_a_load_keeps_no_stage_and_no_copy(spark, tmp_path):
    from ledgerlake.plans import refresh
    from ledgerlake.sinks.merge import path_exists
    lake = refresh.Lake(spark, str(tmp_path / "lake"))
    rows = build(spark, SF).dealt("bank_transactions").drop("row_bucket").limit(50)
    rows = spark.createDataFrame(rows.collect(), rows.schema)
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    months = refresh.load(lake, "stg_transactions", rows, lake.path("stage/0"))
    assert not path_exists(spark, lake.path("stage/0"))
    seen = sorted(lake.table("stg_transactions").collect())
    assert sorted(refresh.load(lake, "stg_transactions", rows, lake.path("stage/1"))) == sorted(months)
    assert sorted(lake.table("stg_transactions").collect()) == seen
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == before


def odd_trades(spark):
    """Raw trades with separators, NULL marks and NULLs in their texts."""
    import datetime as dt
    import random
    rng = random.Random(4)
    actions = ["YOU BOUGHT", "YOU SOLD", "REINVESTMENT", "INTEREST EARNED", None, "∅",
               "YOU BOUGHT|S1", "x"]
    rows = [(dt.date(2020, 1, rng.randrange(1, 4)), rng.choice(["A", "A|YOU BOUGHT", None, "∅"]),
             rng.choice(actions), rng.choice(["S1", "S1|S1", None, "∅", "S2"]), "USD",
             rng.choice([1.5, 2.0, None]), rng.choice([1.0, 0.125, None]), rng.choice([-3.0, 3.0]),
             rng.choice(["fidelity", "vanguard", None]), rng.choice(["f_1.csv", "v_2.csv"]), i,
             dt.datetime(2021, 1, 1 + i % 2)) for i in range(900)]
    rows += [(dt.date(2020, 1, 1), a, x, s, "USD", 1.0, 1.0, -1.0, "fidelity", "f_1.csv", 1000 + i,
              dt.datetime(2021, 1, 1)) for i, (a, x, s) in enumerate(
                  [("A|YOU BOUGHT", "x", "S1"), ("A", "YOU BOUGHT|x", "S1"), ("A", "YOU BOUGHT", "x|S1")])]
    return spark.createDataFrame(
        rows, "trade_date date, account string, action string, symbol string, currency string, "
              "price double, quantity double, amount double, source string, source_file string, "
              "pos long, ingested_at timestamp")


def test_ledger_ships_no_hash_and_no_row_that_it_does_not_read(spark):
    """The same ledger from fewer and narrower rows, odd texts included."""
    from ledgerlake.operators.ledger_fold import position_lots
    from ledgerlake.plans import bronze, silver
    raw = odd_trades(spark)
    want = position_lots(silver.stg_trades(bronze.bronze_trades(bronze.deal(raw, bronze.TRADE_KEY()))))
    lean = silver.ledger_trades(bronze.bronze_ledger(
        bronze.deal(bronze.ledger_rows(raw), bronze.TRADE_KEY())))
    assert lean.filter(bronze.trade_hash() != F.col("row_hash")).isEmpty()
    got = position_lots(lean, made_of=([bronze.OCCURRENCE], bronze.trade_hash()))
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    lots = build(spark, SF).position_lots
    assert "_row_hash_bytes" not in lots._jdf.queryExecution().optimizedPlan().toString()


def test_prices_of_a_symbol_share_a_task(spark):
    from ledgerlake.plans import bronze
    m = build(spark, SF)
    facts = m.price_facts.filter("symbol IS NOT NULL AND symbol != '∅'")
    where = facts.withColumn("p", F.spark_partition_id()).groupBy("symbol").agg(
        F.countDistinct("p").alias("tasks"), F.count(F.lit(1)).alias("n"))
    assert where.filter("n > 1").count() and where.filter("tasks > 1").isEmpty()
    assert m.price_facts.filter(bronze.price_hash() != F.col("row_hash")).isEmpty()
    assert len(exchanges(m.price_facts)) == 2  # grouped rows, dealt once


def test_gold_export_writes_no_hash_and_every_table_once(spark):
    """the same gold tables from narrower silver tables."""
    import glob
    from ledgerlake.plans import bronze, roundtrips, silver
    from ledgerlake.operators.ledger_fold import position_lots
    from ledgerlake.session import ensure_checkpoint_dir
    rows = lambda df: sorted(map(repr, df.collect()))
    folders = lambda: set(glob.glob(ensure_checkpoint_dir(spark).removeprefix("file:")
                                    + "/ledgerlake/*"))
    before = folders()
    m, plain = build(spark, SF, gold_only=True), build(spark, SF)
    out = roundtrips.gold_export(m)
    new = [f.rsplit("-", 1)[0].rsplit("/", 1)[1] for f in folders() - before]
    assert sorted(new) == ["card_facts", "gold-export", "gold-trades", "price_facts"]
    for f in folders() - before:
        for part in glob.glob(f + "/**/*.parquet", recursive=True)[:1]:
            assert "row_hash" not in spark.read.parquet(part).columns
    want = plain.gold()
    assert set(out) == set(want)
    for name, df in want.items():
        assert out[name].dtypes == df.dtypes and rows(out[name]) == rows(df), name
        assert out.rows[name] == df.count()
    assert exchanges(m._laid_out_trades().groupBy("symbol", "source").count()) == []

    odd = build(spark, SF, gold_only=True)
    raw = odd_trades(spark)
    odd.cache["ledger_trades"] = silver.ledger_trades(bronze.bronze_ledger(
        bronze.deal(bronze.ledger_rows(raw), bronze.TRADE_KEY())))
    stg = silver.stg_trades(bronze.bronze_trades(bronze.deal(raw, bronze.TRADE_KEY())))
    assert rows(odd.position_lots) == rows(position_lots(stg))
    from ledgerlake.plans.wealth import running_holdings
    assert rows(running_holdings(odd.stg_trades)) == rows(running_holdings(stg))


def odd_prices(spark):
    """Raw prices with copies, NULLs, NULL marks and separators in their symbols."""
    import datetime as dt
    import random
    rng = random.Random(7)
    rows = [(dt.date(2020, 1, rng.randrange(1, 4)) if rng.random() < .9 else None,
             rng.choice(["S1", "S2", "S1|S2", "∅", "", None]), rng.choice([1.0, 2.5, None]),
             rng.choice([dt.datetime(2021, 1, 1), dt.datetime(2021, 1, 2), None]))
            for _ in range(600)]
    rows += [(dt.date(2020, 2, 1), "∅", 1.0, dt.datetime(2021, 1, 1)),
             (dt.date(2020, 2, 1), None, 1.0, dt.datetime(2021, 1, 2)),
             (dt.date(2020, 2, 2), None, 1.0, None), (dt.date(2020, 2, 2), "∅", 1.0, None),
             (dt.date(2020, 2, 3), None, 1.0, None),
             (dt.date(2020, 2, 3), "∅", 1.0, dt.datetime(2021, 1, 2))]
    df = spark.createDataFrame(rows, "price_date date, symbol string, close double, "
                                     "ingested_at timestamp")
    return df.select("price_date", "symbol", "ingested_at", F.lit("USD").alias("currency"), "close",
                     *[F.lit(1.0).alias(c) for c in ("open", "high", "low", "adj_close")],
                     F.lit(1).cast("long").alias("volume"))


def test_latest_price_sorts_narrow_rows_in_tasks_of_their_own(spark):
    """the same prices; no sort carries a hash, and no tasks are merged into one."""
    from ledgerlake.plans import bronze, portfolio, silver
    rows = lambda df: sorted(map(repr, df.collect()))
    dealt = bronze.bronze_prices(bronze.deal(odd_prices(spark), bronze.PRICE_KEY(),
                                             bronze.by_symbol))
    want, got = silver.stg_stock_prices(dealt), silver.price_facts(dealt)
    assert got.columns == silver.PRICE_FACTS
    assert rows(got) == rows(want.select(*silver.PRICE_FACTS))
    assert rows(portfolio.latest_price(got.drop("row_hash"))) == rows(portfolio.latest_price(want))

    m = build(spark, SF)
    assert rows(m.price_facts) == rows(m.stg_stock_prices.select(*silver.PRICE_FACTS))
    latest = QUERIES["latest_price"](spark, SF)
    assert len([x for x in exchanges(latest) if "REPARTITION_BY_NUM" in x]) == 1
    plan = latest._jdf.queryExecution().optimizedPlan().toString()
    assert all("max(struct" in x for x in plan.splitlines() if "sha2(" in x) and "sha2(" in plan
    tasks = m.price_facts.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_ledger_is_sorted_in_tasks_that_are_not_merged(spark):
    """both exchanges of the ledger and that of the prices keep all shuffle partitions."""
    df = QUERIES["growth_preview"](spark, SF)
    assert len([x for x in exchanges(df) if "REPARTITION_BY_NUM" in x]) == 3
    lots = build(spark, SF).position_lots
    tasks = lots.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks == int(spark.conf.get("spark.sql.shuffle.partitions"))
