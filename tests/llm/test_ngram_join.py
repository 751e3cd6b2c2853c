import random

from llm_brute import components

from tidelane.llm import ngram_join as module
from tidelane.llm.ngram_join import ngram_components, ngram_join

SCHEMA = "doc_id long, text string"


def families(seed, count, words=40, copies=8):
    """Near copies of invented texts, with edits around the threshold and one shared passage."""
    deal = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = " ".join(deal.choices(vocabulary, k=60))
    rows = []
    for family in range(count):
        base = deal.choices(vocabulary, k=deal.randint(3, words))
        for _ in range(deal.randint(1, copies)):
            text = list(base)
            for _ in range(deal.randint(0, 3)):
                text[deal.randrange(len(text))] = deal.choice(vocabulary)
            if deal.random() < 0.3:
                text.append(deal.choice(vocabulary))
            rows.append(" ".join(text) if family % 3 else passage + " " + " ".join(text))
    deal.shuffle(rows)
    return list(enumerate(rows))


def found(frame):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in frame.collect()}


def test_equals_all_pairs(spark):
    rows = families(1, 60)
    assert found(ngram_components(spark.createDataFrame(rows, SCHEMA))) == components(rows)


def test_tree_and_blocks_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(module, "LEAF", 4)
    monkeypatch.setattr(module, "BLOCK", 6)
    rows = families(2, 6, words=30, copies=40)
    assert found(ngram_components(spark.createDataFrame(rows, SCHEMA))) == components(rows)


def test_edges(spark):
    long = " ".join(f"a{i}" for i in range(30_000))
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one\ttwo"), (6, "one two three"),
        (7, long), (8, long + " end"), (9, "É x"), (10, "é x"), (None, "one two"), (7, long), (11, "a b c d e"), (12, "A B C D E"),
    ]
    frame = spark.createDataFrame([(i, t, 1, i) for i, t in rows], "doc_id long, text string, class int, gram long")
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in ngram_components(frame).collect())
    assert got == [
        (-1, 1, 4), (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 6), (7, 29996, 7), (7, 29996, 7),
        (8, 29997, 7), (9, 1, 9), (10, 1, 10), (11, 1, 11), (12, 1, 11),
    ]
    assert sorted(r.doc_id for r in ngram_join(frame).collect()) == [1, 2, 3, 4, 6, 7, 7, 9, 10, 11]


def test_rows_without_ids(spark):
    words = [f"b{i}" for i in range(60)]
    head, tail = [f"c{i}" for i in range(5)], [f"e{i}" for i in range(5)]
    chain = [" ".join(x) for x in (words, words[:55] + tail, head + words[5:55] + tail)]
    alone = " ".join(f"d{i}" for i in range(40))
    rows = [
        (1, chain[0]), (None, chain[1]), (2, chain[2]), (None, "only one"), (None, "only one"), (None, ""), (None, None), (None, " "), (3, ""),
        *[(None, alone)] * 9, (None, alone + " end"), (None, "no copy of this"),
    ]
    # The ends of the chain link by the row without an id alone.
    assert len({c for _, c in components([(1, chain[0]), (2, chain[2])]).values()}) == 2
    frame = spark.createDataFrame([(t, i, n) for n, (i, t) in enumerate(rows)], "text string, doc_id long, n long").repartition(6)
    assert {r.component_id for r in ngram_components(frame).collect() if r.doc_id in (1, 2)} == {1}
    got = ngram_join(frame)
    assert got.columns == frame.columns
    kept = sorted((r.doc_id or -1, r.text or "") for r in got.collect())
    ends = [r for r in kept if r[1] in (alone, alone + " end")]
    assert len(ends) == 1
    assert [r for r in kept if r not in ends] == [(-1, ""), (-1, ""), (-1, " "), (-1, "no copy of this"), (-1, "only one"), (1, chain[0]), (3, "")]


def test_empty(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert ngram_components(frame).collect() == []
    assert ngram_join(frame).collect() == []


def counted(monkeypatch):
    """Numbers of pairs that the trees give, as they come."""
    made, plain = [], module._tree_pairs

    def pairs(*args):
        found = plain(*args)
        made.append(found.count())
        return found

    monkeypatch.setattr(module, "_tree_pairs", pairs)
    return made


def test_pairs_do_not_grow_with_the_square_of_a_passage(spark, monkeypatch):
    """Texts with most of a passage in common, not enough to link, and copies of some of them."""
    made = counted(monkeypatch)
    passage = " ".join(f"p{i}" for i in range(420))
    rows = [(k, passage + " " + " ".join(f"o{k}x{i}" for i in range(120))) for k in range(120)]
    rows += [(200 + k, rows[k][1] + " end") for k in range(0, 120, 40)]
    want = {k: (len(text.split()) - 4, k - 200 if k >= 200 else k) for k, text in rows}
    assert found(ngram_components(spark.createDataFrame(rows, SCHEMA))) == want
    assert made[0] <= len(rows)


def test_components_of_links(spark):
    deal = random.Random(5)
    links = [(deal.randrange(400), deal.randrange(400)) for _ in range(250)] + [(i, i + 1) for i in range(500, 540)]
    links += links[:50] + [(b, a) for a, b in links[50:90]] + [(7, None), (None, None), (450, 450)]
    least = {x: x for link in links if None not in link and link[0] != link[1] for x in link}
    for _ in least:
        before = dict(least)
        for a, b in links:
            if a in least and b in least:
                least[a] = least[b] = min(least[a], least[b])
        if before == least:
            break
    frame = module.components(spark.createDataFrame(links, "a long, b long"), "a", "b")
    assert sorted((r.node, r.root) for r in frame.collect()) == sorted(least.items())
