import math
import random
import re
from collections import Counter, defaultdict

import pytest

from tidelane.llm import url_filter as module
from tidelane.llm.queries import RULES
from tidelane.llm.url_filter import filter_urls

URLS = [
    "http://www.Example.COM/en/1", "http://a.example.com/en/1", "http://example.com/fr/", "http://x.com", "http://xcom/", "http://net/es/", "ftp://a.net/fr/?q",
    "http://b.net/fr", "http://com/?x", "no scheme", "", None, "://h/p", "http://a?b://c", "http://a.example.com/en/", "x://y://z.com/", "HTTP://ÀB.com/é\n#x", "http://www.example.com/EN/",
]


def plain(url):
    _, mark, rest = (url or "").partition("://")
    host = re.split("[/?#]", rest)[0] if mark else ""
    path = re.split("[?#]", rest[len(host) :])[0] if mark else ""
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for verdict, rule in RULES:
        at, _, start = rule.partition("/")
        if (host == at or host.endswith("." + at)) and path.startswith("/" + start) and len(rule) > len(best[1] if best else ""):
            best = verdict, rule
    return host, path, best


def test_rules(spark):
    frame = spark.createDataFrame([(i, u, 1.0) for i, u in enumerate(URLS)], "page_id long, url string, score double")
    rows = {r.page_id: r for r in filter_urls(frame, RULES).collect()}
    for i, url in enumerate(URLS):
        host, path, best = plain(url)
        assert (rows[i].host, rows[i].path, rows[i].rule) == (host, path, best and best[1]), url
        assert rows[i].verdict == best[0] if best else rows[i].verdict in ("allow", "block")


def test_models_tell_unseen_urls_apart(spark):
    good = [f"https://news{i % 7}.com/story/{i}" for i in range(300)]
    bad = [f"https://pills{i % 7}.net/es/cheap-pills-{i}" for i in range(300)]
    new = [f"https://news{i % 7}.org/story/x{i}" for i in range(50)] + [f"https://pills{i % 7}.org/cheap-pills-z{i}" for i in range(50)]
    frame = spark.createDataFrame(list(enumerate(good + bad + new)), "page_id long, url string")
    rows = {r.url: r for r in filter_urls(frame, RULES).collect()}
    right = [rows[u].verdict == ("allow" if i < 50 else "block") for i, u in enumerate(new)]
    assert sum(right) >= 95


def test_no_rule_hits_and_empty(spark):
    frame = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert filter_urls(frame, RULES).first().verdict == "allow"
    assert filter_urls(frame.limit(0), RULES).collect() == []


def plain_model(urls):
    """Followers of each context, by plain dictionaries."""
    seen = defaultdict(Counter)
    for data in (u.encode() for u in urls):
        for i, byte in enumerate(data):
            for order in range(min(i, module.ORDER) + 1):
                seen[data[i - order : i]][byte] += 1
    return seen


def plain_log(seen, data):
    total = 0.0
    for i, byte in enumerate(data):
        p = 1 / 256
        for order in range(min(i, module.ORDER) + 1):
            found = seen.get(data[i - order : i])
            if found:
                p = (found[byte] + len(found) * p) / (sum(found.values()) + len(found))
        total += math.log(p)
    return total


def test_scores_equal_plain_models(spark, monkeypatch):
    monkeypatch.setattr(module, "PART", 64)
    deal = random.Random(5)
    word = lambda: "".join(deal.choices("abcdefghijklmnopqrstuvwxyz0123456789-é", k=deal.randint(1, 9)))
    urls = [f"https://{word()}.{deal.choice(['com', 'net', 'org'])}/{deal.choice(['es', 'fr', 'en'])}/{word()}?{word()}" for _ in range(500)]
    urls += [urls[0]] * 200 + ["", None, "é", "x" * 5000, "https://a.com/" + "".join(map(word().__add__, urls[:40]))]
    frame = spark.createDataFrame([(i, u, u, 1) for i, u in enumerate(urls)], "part long, url string, row string, gram int").repartition(3)
    # Whether a URL is kept out is Spark's hash.
    kept = {r.url for r in frame.filter("pmod(xxhash64(coalesce(url, '')), 5) = 0").collect()}
    rules = {u: (plain(u)[2] or [None])[0] for u in urls}
    models = [plain_model(u for u in urls if rules[u] == kind and u not in kept) for kind in ("allow", "block")]
    rows = filter_urls(frame, RULES).collect()
    assert sorted(r.part for r in rows) == list(range(len(urls)))
    for r in rows:
        data = (urls[r.part] or "").encode()
        wanted = (plain_log(models[0], data) - plain_log(models[1], data)) / max(len(data), 1)
        assert r.score == pytest.approx(wanted, abs=1e-9) and r.row == urls[r.part] and r.gram == 1


def test_contexts_are_not_limited(spark):
    deal = random.Random(6)
    urls = ["".join(chr(deal.randrange(33, 127)) for _ in range(100)) for _ in range(900)]
    frame = spark.createDataFrame([(u, 1) for u in urls], "url string, teaches int")
    grams = {(min(i, 4), u[max(i - 4, 0) : i + 1]) for u in urls for i in range(len(u))}
    counted = module._counts(frame)
    assert len(grams) > 70_000
    assert counted.filter("gram >= 4 * power(2, 40)").count() == len({g for o, g in grams if o == 4})
