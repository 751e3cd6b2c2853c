from tests.frames import deal_tables, offer_tables, rows, time
from tidelane.operators.index import SERIES
from tidelane.plans import dashboards, index_run
from tidelane.plans.session import scratch
from tidelane.schemas import TABLES
from tidelane.sources import readers, sinks


def test_jdbc_options_split_by_id():
    options = readers.jdbc_options(
        "jdbc:x://h/d", "s.FTR_DEAL", {"user": "u"}, bounds=(1, 900), partitions=8
    )
    assert options["partitionColumn"] == "ID"
    assert (options["lowerBound"], options["upperBound"], options["numPartitions"]) == (
        "1", "900", "8"
    )
    assert options["dbtable"] == "s.FTR_DEAL" and options["user"] == "u"
    single = readers.jdbc_options("u", "t", {}, bounds=(5, 5), partitions=2)
    assert single["upperBound"] == "6"


def test_tables_on_parquet_and_views(spark, tmp_path):
    tables = deal_tables(spark, [("D1", time("20200101"), 1, 1)])
    for name in ("FTR_DEAL", "MDM_CRYR"):
        sinks.overwrite(tables[name], f"{tmp_path}/{name}")
    read = readers.read_tables(spark, str(tmp_path), ["FTR_DEAL", "MDM_CRYR"])
    assert rows(read["FTR_DEAL"]) == rows(tables["FTR_DEAL"])
    sinks.append(tables["MDM_CRYR"], f"{tmp_path}/MDM_CRYR")
    assert readers.read_parquet(spark, f"{tmp_path}/MDM_CRYR").count() == 4
    readers.register(read, cached=True)
    assert readers.registered(spark, ["FTR_DEAL"])["FTR_DEAL"].count() == 1
    for table in read.values():
        table.unpersist()


def test_empty_and_inline(spark):
    assert readers.or_empty({}, "FTR_DEAL_RTE", spark).columns == TABLES["FTR_DEAL_RTE"].names
    assert readers.empty(spark, TABLES["FTR_DEAL"]).filter("OFER_TP_CD = 'S'").count() == 0
    assert rows(readers.inline(spark, [(1, "tick")], "n int, name string")) == [(1, "tick")]


def test_scratch_lies_in_the_shared_folder(spark):
    first, second = scratch(spark, "x"), scratch(spark, "x")
    assert first.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert first != second


def test_index_run(spark, tmp_path):
    from datetime import date

    def quotes(name, value):
        row = ("s", "c", "i", name, date(2020, 1, 6), value, "1", "T", "USD")
        return spark.createDataFrame([row], TABLES["INDEX"])

    root = str(tmp_path)
    index_run.build_indices(spark, quotes("a", 1.0).unionAll(quotes("b", 2.0)), root)
    index_run.refresh_indices(spark, quotes("b", 5.0), root)
    stored = sinks.read_keyed(spark, f"{root}/MI_SUM")
    values = {(row.idxNm, row.interval): row.Cell[0].value for row in stored.collect()}
    assert values[("a", "weekly")] == 1.0 and values[("b", "weekly")] == 5.0 and len(values) == 6
    detail = spark.createDataFrame([("daily",)], "interval string")
    index_run.build_catalogue(stored, detail, root)
    catalogue = spark.read.parquet(f"{root}/IDX_LST")
    assert rows(catalogue, *SERIES[2:]) == [
        ("MWWD", "market watch weekdetail frequencies"), ("i", "a"), ("i", "b")
    ]


def test_dashboards(spark, tmp_path):
    numbers = ["F" + time("20200101", n) for n in range(4)]

    def tables(left):
        return offer_tables(
            spark,
            [{"OFER_NR": n, "EMP_NR": f"U{i % 2}"} for i, n in enumerate(numbers)],
            [{"OFER_NR": n, "BSE_YW": "202012", "OFER_PRCE": 1, "OFER_QTY": 9, "DEAL_PRCE": 1,
              "OFER_REMN_QTY": left} for n in numbers],
        )

    root, rebuilt = str(tmp_path / "live"), str(tmp_path / "full")
    dashboards.write_offer_raw(tables(5), root)
    dashboards.write_offer_raw(tables(5), root, add=True)
    assert spark.read.parquet(f"{root}/OFFER_RAW").count() == 8
    dashboards.full_build(tables(5), root, "202010", buckets=2)
    dashboards.full_build(tables(0), rebuilt, "202010", buckets=2)
    changed = tables(0)
    users = spark.createDataFrame([("U0",), ("U1",)], "EMP_NR string")
    dashboards.refresh_users(spark, changed, users, root, "202010", buckets=2)
    offers = spark.createDataFrame([(n,) for n in numbers], "OFER_NR string")
    dashboards.refresh_offers(spark, changed, offers, root, "202010", buckets=2)
    for name in ("OFFER_SUM", "OFFER_WKLIST", "OFFER_RTELIST", "OFFER_WKDETAIL", "OFFER_EVNTLOG"):
        live, full = (sinks.read_keyed(spark, f"{r}/{name}") for r in (root, rebuilt))
        assert rows(live) == rows(full), name


def test_jdbc_ranges_follow_the_rows_and_cover_every_id_once():
    import random

    deal = random.Random(4)
    ids = [*range(1000), *deal.sample(range(10**9, 10**9 + 10**6), 3000), *[-5] * 500, 10**12]
    low, width = min(ids), -(-(max(ids) - min(ids) + 1) // 4096)
    cells = {}
    for i in ids:
        cells[(i - low) // width] = cells.get((i - low) // width, 0) + 1
    even = {k: 1 for k in range(100)}
    for histogram, start, step, rows_ in ((cells, low, width, ids), (even, 0, 10, list(range(1000)))):
        cuts = readers.quantile_cuts(histogram, start, step, 8)
        assert cuts == sorted(set(cuts)) and len(cuts) < 8
        import duckdb

        table = duckdb.sql(f"SELECT unnest({rows_} || [NULL, NULL]) AS ID")  # noqa: F841
        counts = [duckdb.sql(f"SELECT count(*) FROM table WHERE {p}".replace("FROM table", "FROM \"table\"")).fetchall()[0][0] for p in readers.split_predicates("ID", cuts)]
        assert sum(counts) == len(rows_) + 2
        assert max(counts) <= max(2 + 2 * len(rows_) / 8, max(histogram.values()) * 1.01 + len(rows_) / 8 + 2)
    assert readers.split_predicates("ID", readers.quantile_cuts({}, 0, 1, 8)) == ["1 = 1"]
    assert max(readers.quantile_cuts(even, 0, 10, 1), default=None) is None


def test_histogram_query_counts_cells():
    import duckdb

    table = duckdb.sql("SELECT unnest([3, 4, 13, 23, NULL]) AS ID")  # noqa: F841
    found = duckdb.sql(readers.id_histogram_query('"table"', "ID", 3, 10)).fetchall()
    assert sorted((int(c), n) for c, n in found) == [(0, 2), (1, 1), (2, 1)]


def test_malformed_lines_are_kept_aside(spark, tmp_path):
    import pytest
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL("id int, day date, name string")
    (tmp_path / "a.csv").write_text("id,day,name\n1,2020-01-05,x\nzwei,2020-01-05,y\n3,2020-13-45,z\n4,,\n5\n6,2020-01-06,a,b\n")
    (tmp_path / "b.csv").write_text("id,day,name\n7,2020-01-07,w\n")
    good, bad = readers.read_csv_parts(spark, str(tmp_path), schema)
    assert good.schema == schema and sorted(r.id for r in good.collect()) == [1, 4, 7]
    assert sorted(r.corrupt_line for r in bad.collect()) == ["3,2020-13-45,z", "5", "6,2020-01-06,a,b", "zwei,2020-01-05,y"]
    aside = str(tmp_path.parent / "quarantine")
    assert readers.quarantined(bad, aside, "a") == 4
    assert spark.read.parquet(aside).filter("source = 'a'").count() == 4
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILFAST"):
        readers.read_csv(spark, str(tmp_path), schema).collect()
    with pytest.raises(readers.HeaderError, match="nom"):
        readers.read_csv(spark, str(tmp_path), StructType.fromDDL("id int, day date, nom string"))


def test_marks_come_from_file_footers(spark, tmp_path):
    from tidelane.operators import changes

    tables = deal_tables(spark, [("D1", time("20200101"), 1, 1), ("D2", time("20200101"), 1, 1)])
    names = ["FTR_DEAL", "FTR_DEAL_RTE", "FTR_DEAL_CRYR"]
    for name in names:
        tables[name].write.parquet(f"{tmp_path}/{name}")
    marks = readers.footer_marks(spark, str(tmp_path), names)
    assert rows(marks) == rows(changes.max_id(tables, names)) and ("FTR_DEAL_CRYR", None) in rows(marks)
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    plan = readers.max_of_files(own, f"{tmp_path}/FTR_DEAL", TABLES["FTR_DEAL"], "ID")._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MAX(ID)]" in plan


def test_new_quotes_touch_their_buckets_and_successors(spark, tmp_path):
    from datetime import date, timedelta

    from tidelane.operators import index

    start = date(2019, 11, 4)
    given = [("s", "c", f"i{k % 3}", f"n{k % 2}", start + timedelta(days=5 * k), float(k % 11), "1", "T", "USD") for k in range(60)]
    late = [("s", "c", "i0", "n0", date(2019, 12, 3), 99.0, "1", "T", "USD"), ("s", "c", "i9", "n1", date(2021, 1, 3), 4.0, "1", "T", "USD")]
    old, new = (spark.createDataFrame(x, TABLES["INDEX"]) for x in (given, late))
    for chronological in (False, True):
        updated = index.mi_sum_updated(index.mi_sum_rows(old, chronological), old.unionByName(new), new, chronological)
        assert rows(updated) == rows(index.mi_sum_rows(old.unionByName(new), chronological))
    root = str(tmp_path)
    index_run.build_series(spark, old, root, buckets=16)
    before = sinks.state_of(spark, f"{root}/MI_ROWS")
    one = new.filter("idxNm = 'n0'")
    for _ in range(2):
        index_run.add_quotes(spark, old.unionByName(one), one, root)
        assert rows(sinks.read_keyed(spark, f"{root}/MI_ROWS")) == rows(index.mi_sum_rows(old.unionByName(one)))
    after = sinks.state_of(spark, f"{root}/MI_ROWS")
    assert sum(before.generations[b] != after.generations[b] for b in before.generations) <= 3


def test_only_small_masters_are_sent_to_every_task(spark, tmp_path):
    from tidelane.functions.values import estimated_bytes, sized
    from tidelane.operators import fact

    spark.range(2000).selectExpr("concat('C', id) AS CRYR_CD", "uuid() AS CRYR_NM").write.parquet(str(tmp_path / "m"))
    master = spark.read.parquet(str(tmp_path / "m"))
    hinted = lambda frame: "broadcast" in frame._jdf.queryExecution().analyzed().toString().lower()
    assert estimated_bytes(master) > 10_000
    assert hinted(sized(master)) and not hinted(sized(master, 10_000))
    tables = deal_tables(spark, [("D1", time("20200101"), 1, 1)], ["C1"])
    tables["MDM_CRYR"] = master
    assert hinted(fact.deal_carriers(tables))
