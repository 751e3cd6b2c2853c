import json

import pytest
from pyspark.sql import functions as F

from tests.frames import deal_tables, rows, time
from tidelane.functions.bloom import bloom, may_hold
from tidelane.functions.values import topic_name
from tidelane.operators import changes, market
from tidelane.operators.fact import ROUTE, restrict, trade_fact
from tidelane.plans import market_watch
from tidelane.plans.market_watch import Store
from tidelane.sources import outbox, sinks
from tidelane.sources.files import Folder
from tidelane.streaming import deals as stream

NOW = "202010"


def some_deals(first, last):
    ports = ["A", "B", None]
    return [
        {"number": f"D{n:03d}", "time": time("20200101", n), "price": n + 1, "quantity": 1,
         "pol": ports[n % 3], "pod": "Z", "week": ["202009", "202011"] if n % 2 else "202010"}
        for n in range(first, last)
    ]


def both(spark, old, new):
    """Tables holding ``old`` deals, and tables that hold ``new`` ones as well."""
    everything = deal_tables(spark, some_deals(0, old + new), ["C1", "C2"])
    before = {
        name: table.filter(F.col("ID") <= old) if name.startswith("FTR") else table
        for name, table in everything.items()
    }
    return before, everything


def same(left, right):
    return rows(left, *sorted(left.columns)) == rows(right, *sorted(right.columns))


def documents_of(spark, store):
    return {name: rows(store.read(spark, name)) for name in Store.keys}


def test_marks_lag_and_gate(spark):
    before, after = both(spark, 5, 2)
    lag = changes.lag_behind(changes.max_id(after), changes.max_id(before))
    assert set(rows(lag, "maxId", "processedId", "advanced")) == {(7, 5, True)}
    assert rows(changes.gate(lag, require_all=True)) == [(5, True)]
    four = lag.filter("tableName <> 'FTR_DEAL_RSLT'")
    assert rows(changes.gate(four, require_all=True), "fire") == [(False,)]
    assert rows(changes.gate(four), "fire") == [(True,)]
    idle = changes.lag_behind(changes.max_id(after), changes.max_id(after))
    assert rows(changes.gate(idle)) == [(0, False)]
    assert set(rows(changes.next_marks(lag), "maxId")) == {(7,)}


def test_first_run_has_no_marks(spark):
    _, after = both(spark, 1, 1)
    nothing = spark.createDataFrame([], "tableName string, maxId long")
    lag = changes.lag_behind(changes.max_id(after), nothing)
    assert set(rows(lag, "advanced")) == {(True,)}
    assert changes.delta(after, nothing)["FTR_DEAL"].count() == 2


def test_topics(spark):
    tables = deal_tables(
        spark,
        [{"number": f"D{n}", "time": time("20200101", n), "price": 1, "quantity": 1,
          "week": ["202010", "202011"]} for n in (1, 2)],
    )
    fact = trade_fact(tables)
    assert rows(changes.route_topics(fact)) == [("A", "B")]
    assert rows(changes.week_topics(fact)) == [("A", "B", "202010"), ("A", "B", "202011")]
    metrics = dict(rows(changes.update_metrics(tables["FTR_DEAL"], fact)))
    assert metrics == {
        "newDeals": 2, "updatedRows": 4, "marketWatchTopics": 1, "weekDetailTopics": 6,
        "dealHistoryTopics": 2,
    }


def test_incremental_equals_full_restricted_to_topics(spark):
    _, tables = both(spark, 5, 4)
    weeks = spark.createDataFrame(
        [("A", "Z", "202009"), ("B", "Z", "202010")], "polCode string, podCode string, "
        "baseYearWeek string"
    )
    routes = weeks.select(*ROUTE).distinct()
    full = trade_fact(tables)
    assert same(
        changes.mw_sum_incr(tables, routes, NOW),
        market.mw_sum(restrict(full, routes), NOW),
    )
    assert same(
        changes.mw_hst_incr(tables, weeks), market.mw_hst(restrict(full, weeks))
    )
    detail = changes.mw_wkdetail_incr(tables, weeks)
    assert same(detail, market.mw_wkdetail(restrict(full, weeks)))


def test_new_line_of_an_old_deal_is_noticed(spark):
    before, after = both(spark, 5, 2)
    late = {
        name: (before if name in ("FTR_DEAL", "FTR_DEAL_RTE", "FTR_DEAL_CRYR") else after)[name]
        for name in after
    }
    lines = before["FTR_DEAL_LINE_ITEM"]
    late["FTR_DEAL_LINE_ITEM"] = lines.unionByName(
        lines.filter("ID = 1").withColumns({"ID": F.lit(99).cast("long"), "BSE_YW": F.lit("202050")})
    )
    changed = changes.delta(late, changes.max_id(before))
    assert rows(changes.changed_deals(changed), "DEAL_NR") == [("D000",)]
    topics = changes.week_topics(changes.delta_fact(late, changed))
    assert ("A", "Z", "202050") in rows(topics)


def test_replace_is_exact_and_idempotent(spark):
    stored = spark.createDataFrame(
        [("A", "B", "w1", 1), ("A", "B", "w2", 2), (None, "B", "w1", 3)],
        "polCode string, podCode string, baseYearWeek string, v int",
    )
    fresh = spark.createDataFrame([("A", "B", "w1", 9)], stored.schema)
    keys = fresh.select("polCode", "podCode", "baseYearWeek")
    once = changes.upsert_by_key(stored, fresh, keys)
    assert rows(once, "v") == [(2,), (3,), (9,)]
    assert same(changes.upsert_by_key(once, fresh, keys), once)
    missing = stored.filter("v = 3").select(keys.columns)
    assert rows(changes.upsert_by_key(stored, fresh.limit(0), missing, null_keys=True), "v") == [
        (1,), (2,)
    ]


def test_keyed_collection(spark, tmp_path):
    path = str(tmp_path / "c")
    stored = spark.createDataFrame([(f"k{n}", n) for n in range(50)], "k string, v int")
    sinks.write_keyed(stored, path, ["k"], buckets=4)
    assert same(sinks.read_keyed(spark, path), stored)
    gone = spark.createDataFrame([("k1",), ("k2",), ("new",)], "k string")
    fresh = spark.createDataFrame([("k1", 100), ("new", 7)], stored.schema)
    wanted = rows(stored.filter("k NOT IN ('k1', 'k2')").unionByName(fresh))
    for _ in range(2):
        sinks.replace_keyed(spark, path, fresh, gone, buckets=4)
        assert rows(sinks.read_keyed(spark, path)) == wanted


def test_keyed_collection_can_lose_a_whole_bucket(spark, tmp_path):
    path = str(tmp_path / "c")
    stored = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    sinks.write_keyed(stored, path, ["k"], buckets=64)
    sinks.replace_keyed(spark, path, stored.limit(0), stored.filter("v = 1").select("k"), buckets=64)
    assert rows(sinks.read_keyed(spark, path)) == [("b", 2)]


def test_round_equals_full_build(spark, tmp_path):
    before, after = both(spark, 6, 3)
    store = Store(str(tmp_path / "live"), buckets=4)
    market_watch.full_build(spark, before, store, NOW)
    assert not market_watch.update_round(spark, before, store, NOW)
    sent = tmp_path / "sent"
    sent.mkdir()

    def send(topic, key, text, broken=True):
        if broken and "MW_HST" in key:
            raise OSError("gone")
        with open(sent / key.replace("/", "-"), "a") as file:
            file.write(topic + text)

    with pytest.raises(outbox.UndeliveredError):
        market_watch.update_round(spark, after, store, NOW, require_all=True, send=send)
    assert market_watch.update_round(spark, after, store, NOW, require_all=True, send=lambda t, k, x: send(t, k, x, False))
    assert not market_watch.update_round(spark, after, store, NOW)
    rebuilt = Store(str(tmp_path / "full"), buckets=4)
    market_watch.full_build(spark, after, rebuilt, NOW)
    assert documents_of(spark, store) == documents_of(spark, rebuilt)
    texts = {path.name: path.read_text() for path in sent.iterdir()}
    assert {name.split("-")[-2] for name in texts} == {"MW_SUM", "MW_HST", "MW_WKDETAIL"}
    assert all(text.count(market_watch.TOPIC) == 1 for text in texts.values())
    assert Folder(spark, store.path("outbox/messages")).names() == []


def test_stream_equals_full_build(spark, tmp_path):
    before, after = both(spark, 6, 3)
    root, checkpoint = str(tmp_path / "tables"), str(tmp_path / "checkpoint")
    late = {
        name: after[name].join(before[name], "ID", "left_anti")
        for name in after
        if name.startswith("FTR")
    }
    for name, table in before.items():
        table.write.parquet(f"{root}/{name}")
    store = Store(str(tmp_path / "live"), buckets=4)
    market_watch.full_build(spark, before, store, NOW)
    stream.run(spark, root, store, NOW, checkpoint).awaitTermination()
    for name, table in late.items():
        table.select(before[name].columns).write.mode("append").parquet(f"{root}/{name}")
    query = stream.run(spark, root, store, NOW, checkpoint, files_per_batch=2)
    query.awaitTermination()
    assert query.exception() is None
    seen = sum(p.observedMetrics["changes"].rows for p in query.recentProgress if p.numInputRows)
    assert seen == sum(late[name].count() for name in changes.FEEDING)
    rebuilt = Store(str(tmp_path / "full"), buckets=4)
    market_watch.full_build(spark, after, rebuilt, NOW)
    assert documents_of(spark, store) == documents_of(spark, rebuilt)


def test_messages(spark, tmp_path):
    frame = spark.createDataFrame([(n, "A") for n in range(5)], "n int, polCode string")
    documents = sinks.json_documents(frame)
    texts = list(sinks.json_messages(documents.collect(), 2))
    assert texts[0] == '[{"n":0,"polCode":"A"},{"n":1,"polCode":"A"}]'
    assert [text.count("{") for text in texts] == [2, 2, 1]
    outbox = tmp_path / "outbox"
    outbox.mkdir()

    def send(topic, text):
        from uuid import uuid4

        (outbox / uuid4().hex).write_text(topic + text)

    sinks.publish(frame, "/topic/t", send, rows_per_message=100)
    sent = [path.read_text() for path in outbox.iterdir()]
    assert sum(text.count("{") for text in sent) == 5
    assert all(text.startswith("/topic/t[") and text.endswith("]") for text in sent)


def test_topic_name_is_cleaned(spark):
    document = spark.createDataFrame([('{"polCode":"K R","podCode":"C.N_1"}',)], "j string")
    assert rows(document.select(topic_name(F.col("j")))) == [("/topic/01_01_01_KR_CN_1_01",)]


def test_without_a_mark_every_id_is_new(spark):
    table = spark.createDataFrame([(-5,), (0,), (7,), (None,)], "ID long")
    none = spark.createDataFrame([], "tableName string, maxId long")
    some = spark.createDataFrame([("FTR_DEAL", 0)], "tableName string, maxId long")
    ids = lambda processed: sorted(r.ID for r in changes.delta({"FTR_DEAL": table}, processed, ["FTR_DEAL"])["FTR_DEAL"].collect())
    assert ids(none) == [-5, 0, 7]
    assert ids(some) == [7]
    below = table.filter("ID < 0")
    lag = changes.lag_behind(changes.max_id({"FTR_DEAL": below}, ["FTR_DEAL"]), none).first()
    assert lag.advanced is True


def test_another_number_of_buckets_doubles_no_rows(spark, tmp_path):
    path = str(tmp_path / "keyed")
    table = spark.range(40).withColumn("value", F.lit("old"))
    sinks.write_keyed(table, path, ["id"], 4)
    sinks.replace_keyed(spark, path, spark.range(3).withColumn("value", F.lit("new")), spark.range(3), 7)
    found = sorted((r.id, r.value) for r in sinks.read_keyed(spark, path).collect())
    assert found == [(i, "new" if i < 3 else "old") for i in range(40)]


def test_a_replacement_that_dies_before_the_switch_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    path, table = f"{tmp_path}/kept", spark.range(20).withColumn("value", F.lit("old"))
    fresh = spark.range(3).withColumn("value", F.lit("new"))
    sinks.write_keyed(table, path, ["id"], 4)

    def die(*_):
        raise RuntimeError("gone")

    with monkeypatch.context() as patch:
        patch.setattr(sinks, "_commit", die)
        with pytest.raises(RuntimeError):
            sinks.replace_keyed(spark, path, fresh, spark.range(3))
    assert same(sinks.read_keyed(spark, path), table)
    sinks.replace_keyed(spark, path, fresh, spark.range(3))
    sinks.drop_old(spark, path)
    wanted = fresh.unionByName(table.filter("id >= 3"))
    assert same(sinks.read_keyed(spark, path), wanted)


def test_only_touched_buckets_are_read(spark, tmp_path):
    path = str(tmp_path / "keyed")
    table = spark.range(200).select((F.col("id") % 50).alias("k"), F.when(F.col("id") > 5, F.col("id")).alias("v"))
    sinks.write_keyed(table, path, ["k"], 16)
    some = spark.createDataFrame([(3,), (4,), (None,)], "k long")
    found = sinks.read_keyed(spark, path, some)
    assert rows(found) == rows(table.filter("k IN (3, 4)"))
    state = sinks.state_of(spark, path)
    buckets = {r.bucket for r in some.select(sinks._bucket(["k"], 16)).collect()}
    read = {file.split("/bucket=")[1].split("/")[0] for file in found.inputFiles()}
    assert read == {str(b) for b in buckets} and len(read) < len(state.generations)
    assert sinks.read_keyed(spark, path, some.limit(0)).count() == 0


def test_two_writers_lose_nothing(spark, tmp_path, monkeypatch):
    path, table = str(tmp_path / "kept"), spark.range(40).withColumn("value", F.lit("old"))
    sinks.write_keyed(table, path, ["id"], 4)
    commit, other = sinks._commit, []

    def late(*given):
        if not other:  # the other writer replaces rows of every bucket before this one commits
            other.append(True)
            sinks.replace_keyed(spark, path, spark.range(20, 30).withColumn("value", F.lit("other")), spark.range(20, 30))
        return commit(*given)

    with monkeypatch.context() as patch:
        patch.setattr(sinks, "_commit", late)
        sinks.replace_keyed(spark, path, spark.range(10).withColumn("value", F.lit("own")), spark.range(10))
    found = {r.id: r.value for r in sinks.read_keyed(spark, path).collect()}
    assert found == {i: "own" if i < 10 else "other" if 20 <= i < 30 else "old" for i in range(40)}
    assert sinks.state_of(spark, path).version == 2


def test_writers_of_different_buckets_need_no_second_merge(spark, tmp_path, monkeypatch):
    path, table = str(tmp_path / "kept"), spark.range(40).withColumn("value", F.lit("old"))
    sinks.write_keyed(table, path, ["id"], 8)
    bucket = {r.id: r.bucket for r in table.select("id", sinks._bucket(["id"], 8)).collect()}
    one = next(iter(bucket))
    two = next(i for i in bucket if bucket[i] != bucket[one])
    commit, calls = sinks._commit, []

    def late(*given):
        calls.append(True)
        if len(calls) == 1:
            sinks.replace_keyed(spark, path, table.filter(F.col("id") == two).withColumn("value", F.lit("two")), table.filter(F.col("id") == two).select("id"))
        return commit(*given)

    with monkeypatch.context() as patch:
        patch.setattr(sinks, "_commit", late)
        sinks.replace_keyed(spark, path, table.filter(F.col("id") == one).withColumn("value", F.lit("one")), table.filter(F.col("id") == one).select("id"))
    assert len(calls) == 2
    found = {r.id: r.value for r in sinks.read_keyed(spark, path).collect()}
    assert found == {i: {one: "one", two: "two"}.get(i, "old") for i in bucket}


def test_a_version_is_added_once(spark, tmp_path):
    folder = Folder(spark, str(tmp_path / "f"))
    assert folder.names() == [] and folder.add("v1", "first é") and not folder.add("v1", "second")
    assert folder.text("v1") == "first é" and folder.names() == ["v1"]


def test_old_versions_go_but_young_buckets_stay(spark, tmp_path):
    path, table = str(tmp_path / "kept"), spark.range(20).withColumn("value", F.lit("old"))
    sinks.write_keyed(table, path, ["id"], 4)
    for i in range(3):
        sinks.replace_keyed(spark, path, spark.range(1).withColumn("value", F.lit(f"v{i}")), spark.range(1))
    before = rows(sinks.read_keyed(spark, path))
    generations = lambda: len(Folder(spark, f"{path}/data").names())
    sinks.drop_old(spark, path, older_than=3600)
    assert generations() == 4 and Folder(spark, f"{path}/manifest").names() == ["v000000000003.json"]
    sinks.drop_old(spark, path)
    assert generations() == 2 and rows(sinks.read_keyed(spark, path)) == before


def test_a_deal_that_leaves_a_route_is_dropped_there(spark, tmp_path):
    """A route row that comes late moves a deal from an open end to a port: the stored keys tell where it was."""
    before, after = both(spark, 6, 0)
    lone = before["FTR_DEAL_RTE"].filter("DEAL_NR = 'D002'")
    late = lone.limit(1).withColumns({"ID": F.lit(99).cast("long"), "TRDE_LOC_CD": F.lit("A"), "TRDE_LOC_TP_CD": F.lit("02")})
    store = Store(str(tmp_path / "live"), buckets=4)
    market_watch.full_build(spark, before, store, NOW)
    assert "D002" in {r.DEAL_NR for r in store.read(spark, "FACT").filter("polCode IS NULL").collect()}
    now = {**after, "FTR_DEAL_RTE": before["FTR_DEAL_RTE"].unionByName(late)}
    assert market_watch.update_round(spark, now, store, NOW)
    rebuilt = Store(str(tmp_path / "full"), buckets=4)
    market_watch.full_build(spark, now, rebuilt, NOW)
    assert documents_of(spark, store) == documents_of(spark, rebuilt)
    assert "D002" not in {r.DEAL_NR for r in store.read(spark, "FACT").filter("polCode IS NULL").collect()}


def test_a_round_leaves_no_scratch(spark, tmp_path):
    from pathlib import Path

    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before, after = both(spark, 4, 2)
    store = Store(str(tmp_path / "live"), buckets=4)
    market_watch.full_build(spark, before, store, NOW)
    held = set(shared.iterdir())
    assert market_watch.update_round(spark, after, store, NOW)
    assert set(shared.iterdir()) == held


def test_flags_tell_changed_deals(spark):
    before, after = both(spark, 5, 2)
    marks = changes.max_id(before)
    line = before["FTR_DEAL_LINE_ITEM"].filter("DEAL_NR = 'D001'").limit(1).withColumn("ID", F.lit(50).cast("long"))
    after = {**after, "FTR_DEAL_LINE_ITEM": after["FTR_DEAL_LINE_ITEM"].unionByName(line)}
    carrier = before["FTR_DEAL_CRYR"].filter("DEAL_NR = 'D003'").limit(1).withColumn("ID", F.lit(51).cast("long"))
    after = {**after, "FTR_DEAL_CRYR": after["FTR_DEAL_CRYR"].unionByName(carrier)}
    flagged = changes.fact_with_changes(after, marks)
    assert {r.DEAL_NR for r in flagged.filter("changed").collect()} == {"D001", "D003", "D005", "D006"}
    assert same(flagged.drop("changed"), trade_fact(after))
    changed = changes.changed_deals(changes.delta(after, marks))
    assert same(flagged.filter("changed").drop("changed"), trade_fact(after, deals=changed))
    weeks = changes.week_topics(flagged.filter("changed"))
    routes = weeks.select(*ROUTE).distinct()
    assert same(market.mw_sum(flagged, NOW, only_touched=True), changes.mw_sum_incr(after, routes, NOW))
    assert same(market.mw_hst(flagged, only_touched=True), changes.mw_hst_incr(after, weeks))
    assert same(market.mw_wkdetail(flagged, only_touched=True), changes.mw_wkdetail_incr(after, weeks))


def test_touched_by_a_deal_without_price_or_quantity(spark):
    deals = [
        {"number": "D1", "time": time("20200101"), "price": 5, "quantity": 1},
        {"number": "D2", "time": time("20200102"), "price": 0, "quantity": 0},
        {"number": "D3", "time": time("20200102"), "price": 3, "quantity": 1, "pod": "Q"},
    ]
    tables = deal_tables(spark, deals, ["C1"])
    marks = changes.max_id({name: t.filter("ID <> 2") if name.startswith("FTR") else t for name, t in tables.items()}).withColumn("maxId", F.lit(1).cast("long"))
    flagged = changes.fact_with_changes({n: t.filter("DEAL_NR <> 'D3'") if n.startswith("FTR") else t for n, t in tables.items()}, marks)
    third = changes.fact_with_changes(tables, marks.withColumn("maxId", F.lit(3).cast("long"))).filter("DEAL_NR = 'D3'")
    fact = flagged.unionByName(third)
    whole = trade_fact(tables)
    weeks = spark.createDataFrame([("A", "B", "202010")], "polCode string, podCode string, baseYearWeek string")
    assert same(market.mw_hst(fact, only_touched=True), market.mw_hst(restrict(whole, weeks)))
    assert same(market.mw_wkdetail(fact, only_touched=True), market.mw_wkdetail(restrict(whole, weeks)))


def test_day_states_merge_in_any_order(spark):
    deals = [
        (f"D{n}", time(day, n % 3), price, n + 1)
        for n, (day, price) in enumerate([("20200101", 5), ("20200101", 7), ("20200101", 1), ("20200102", 4), ("20200108", 9), ("20200101", 2)])
    ]
    fact = trade_fact(deal_tables(spark, deals, ["C1", "C2"]))
    parts = [market.day_states(fact.filter(F.pmod(F.xxhash64("DEAL_NR"), F.lit(3)) == k)) for k in (2, 0, 1)]
    merged = market.merged_states(market.merged_states(parts[0].unionByName(parts[1])).unionByName(parts[2]))
    assert same(market.wkdetail_of_states(merged), market.mw_wkdetail_rows(fact))


def test_bloom_lets_all_keys_through_and_few_others(spark):
    keys = spark.range(5000).select(F.concat(F.lit("D"), F.col("id")).alias("a"), F.when(F.col("id") > 3, F.col("id")).alias("b"))
    words = bloom(keys)
    table = spark.range(50_000).select(F.concat(F.lit("D"), F.col("id")).alias("a"), F.when(F.col("id") > 3, F.col("id")).alias("b"))
    through = table.filter(may_hold(words, ["a", "b"]))
    assert through.join(keys, "a").count() == 5000
    assert through.count() < 5200
    assert table.filter(may_hold(bloom(keys.limit(0)), ["a", "b"])).count() == 0


def test_a_sender_that_dies_midway_sends_each_message_once(spark, tmp_path):
    root, sent = str(tmp_path / "outbox"), tmp_path / "sent"
    sent.mkdir()
    frame = spark.range(300).select("id", F.when(F.col("id") > 0, F.lit("x")).alias("v"))
    outbox.enqueue(frame, root, "7", "/topic/t", ["id"], rows_per_message=10)
    numbers = sorted(r.number for r in outbox.pending(spark, root, "7").collect())
    dead = numbers[len(numbers) // 2]

    def send(topic, key, text, broken=True):
        if broken and key == f"7/{dead}":
            raise OSError("gone")
        with open(sent / key.replace("/", "-"), "a") as file:
            file.write(text + "\n")

    with pytest.raises(outbox.UndeliveredError, match="gone"):
        outbox.deliver(spark, root, "7", send, tasks=2)
    outbox.enqueue(frame.limit(5), root, "7", "/topic/t", ["id"])  # a repeated round writes no other messages
    some = len(list(sent.iterdir()))
    left = outbox.deliver(spark, root, "7", lambda t, k, x: send(t, k, x, False))
    assert 0 < left < len(numbers) and some + left == len(numbers)
    texts = [path.read_text().splitlines() for path in sent.iterdir()]
    assert all(len(lines) == 1 for lines in texts) and len(texts) == len(numbers)
    found = [row for (line,) in texts for row in json.loads(line)]
    assert sorted(row["id"] for row in found) == list(range(300)) and {"id": 0, "v": None} in found
    assert max(len(json.loads(line)) for (line,) in texts) <= 10
    assert outbox.deliver(spark, root, "7", send) == 0
    outbox.forget(spark, root, "7")
