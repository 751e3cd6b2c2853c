import re

import numpy as np
import pytest

from tidelane.llm.mixing import TOPICS, mix, profiled, rake, reachable, tempered


def test_raking_meets_all_margins():
    deal = np.random.default_rng(1)
    tokens = deal.integers(100, 1000, (4, 3, 2))
    targets = [np.array(s) * 0.5 * tokens.sum() for s in ([0.3, 0.2, 0.25, 0.25], [0.4, 0.3, 0.3], [0.55, 0.45])]
    p = rake(tokens, targets)
    assert p.min() >= 0 and p.max() <= 1
    for axis, target in enumerate(targets):
        others = tuple(i for i in range(3) if i != axis)
        assert (p * tokens).sum(axis=others) == pytest.approx(target, rel=1e-6)


def test_probabilities_stop_at_one():
    p = rake(np.array([[10, 1000]]), [np.array([505.0]), np.array([100.0, 405.0])])
    assert p[0, 0] == 1 and 0 < p[0, 1] < 1


def test_documents_follow_targets(spark):
    rows = [(i, "abc " * (5 + i % 11) + "xyz", f"s{min(i % 10, 3)}", "en" if i % 3 else "de") for i in range(4000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    target = {"source": {"s0": 0.2, "s1": 0.2}, "lang": {"en": 0.5, "de": 0.5}}
    got = mix(frame, target, budget=0.4).collect()
    assert len(got) == len(rows)
    total = sum(r.n_tokens for r in got)
    for name, margin in target.items():
        for value, share in margin.items():
            expected = sum(r.probability * r.n_tokens for r in got if r[name] == value)
            assert expected == pytest.approx(share * 0.4 * total, rel=1e-4)
            drawn = sum(r.n_tokens for r in got if r[name] == value and r.sampled)
            assert drawn == pytest.approx(share * 0.4 * total, rel=0.15)
    assert all(r.weight == pytest.approx(1 / r.probability) for r in got)


def test_scarce_classes_do_not_bound_what_is_drawn(spark):
    for size in (1000, 4000):
        rows = [(i, "go " * 8 if i < 3 else "abc " * 8 if i % 2 else "xyz " * 8, f"s{i % 2}" if i % 50 else f"rare{i}", "en") for i in range(size)]
        frame = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
        got = mix(frame, classes={"source": 2, "lang": ["en", "de"], "topic": list(TOPICS)}, budget=0.8).collect()
        assert sum(r.probability * r.n_tokens for r in got) == pytest.approx(0.8 * 8 * size, rel=1e-3)
        assert all(r.probability == pytest.approx(1, abs=1e-3) for r in got if r.topic == "g-m")
        for value, share in (("s0", 0.48), ("s1", 0.5), ("rare", 0.02)):
            drawn = sum(r.probability * r.n_tokens for r in got if r.source.startswith(value))
            assert drawn == pytest.approx(share * 0.8 * 8 * size, rel=0.01)


def test_targets_of_scarce_classes_pass_to_others():
    assert reachable(np.array([0.5, 0.25, 0.25, 0.0]), np.array([10, 500, 500, 9]), 500.0).tolist() == [10, 245, 245, 0]
    assert reachable(np.array([0.5, 0.5]), np.array([3, 4]), 7.0).tolist() == [3, 4]


def test_profile_equals_plain_count(spark):
    texts = ["Apple bee zoo", "9 -- x", "", None, "\u00e9t\u00e9 \t\nq", "no no a A", "w" * 3_000_000 + " b"]
    frame = spark.createDataFrame([(i, t, "mine") for i, t in enumerate(texts)], "doc_id long, text string, topic string")
    for r in profiled(frame).collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id] or "")
        counts = [sum(w[0].lower() in letters and w[0].isascii() for w in words) for letters in TOPICS.values()]
        wanted = list(TOPICS)[counts.index(max(counts))] if any(counts) else "other"
        assert (r.n_tokens, r.topic) == (len(words), wanted)


def test_edges(spark):
    rows = [(None, None, None, None, 1.0), (1, "", "s9", "xx", 1.0), (1, "a b", "s0", None, 1.0), (1, "a b", "s0", None, 1.0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, probability double")
    got = mix(frame, classes={"source": ["s0"], "lang": ["en"], "topic": list(TOPICS)}).collect()
    assert len(got) == 4 and all(0 <= r.probability <= 1 for r in got)
    assert mix(frame.limit(0), classes={"source": ["s0"]}).collect() == []


def test_tempered_shares():
    shares = tempered({"a": 800, "b": 100, "other": 100}, 0.5)
    assert sum(shares.values()) == pytest.approx(1) and shares["other"] == pytest.approx(0.1)
    assert shares["a"] / shares["b"] == pytest.approx(8**0.5)
    assert tempered({"other": 5}, 0.5) == {"other": 1.0} and tempered({}, 0.5) == {}


def test_rows_without_ids_are_drawn_each_by_its_text(spark):
    rows = [(None, f"word{i} more words", "s", "en") for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    drawn = mix(frame, classes={"source": 3}, budget=0.5).filter("sampled").count()
    assert 140 < drawn < 260
