import random

import duckdb
import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from chainlake.llm import urlfilter

URLS = ["http://A.Example.com/en/1", "https://www.example.com/en/x?q#f", "ftp://example.com/en", "http://b.www.example.com/en/", "http://x.net/es/?a", "http://net/fr/", "x.net/es/",
        None, "", "://", "http://com", "http://com/", "http://xcom/", "http://a.com?x=/en/", "http://u@Ü.COM:80/É://x", "a://b://c.com/", "http://.com/", "http://a..net/es/\nb"]


def brute_judge(url, rules, default=urlfilter.ALLOW):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
        rest = rest[:end]
        k = rest.find("/")
        host, path = (rest, "") if k < 0 else (rest[:k], rest[k:])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = []
    for verdict, rule in rules:
        rhost, _, rest = rule.partition("/")
        if host and (host == rhost or host.endswith("." + rhost)) and path.startswith(rule[len(rhost) :]):
            fits.append((len(rule), len(rhost), rule, verdict))
    return (host, path, max(fits)[2], max(fits)[3]) if fits else (host, path, None, default)


def test_urls(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)) + [(None, URLS[0])], "page_id long, url string").selectExpr("*", "'clash' AS host", "1 AS rule")
    for rules in (urlfilter.RULES, (), (*urlfilter.RULES, ("block", "a.example.com/e"), ("allow", "example.com"))):
        found = {r.page_id: tuple(r)[1:] for r in urlfilter.judge(pages, rules).collect()}
        want = {i: brute_judge(u, rules) for i, u in enumerate(URLS)}
        assert found == want | {None: want[0]}
    assert urlfilter.judge(pages.limit(0)).count() == 0


parts = st.sampled_from(["a", "b", "com", "net"])


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["allow", "block"]), st.lists(parts, min_size=1, max_size=3), st.sampled_from(["", "/", "/a", "/a/", "/a/b"])), max_size=8, unique_by=lambda r: (tuple(r[1]), r[2])), st.lists(st.tuples(st.lists(parts, min_size=1, max_size=4), st.sampled_from(["", "/", "/a", "/ab", "/a/b/c?x"])), max_size=10))
def test_any_rules(tmp_path_factory, rules, urls):
    rules = [(v, ".".join(h) + p) for v, h, p in rules]
    path = tmp_path_factory.mktemp("index") / "rules.idx"
    path.write_bytes(urlfilter.build(rules))
    index = urlfilter.Index(str(path))
    for u in [f"http://{'.'.join(h)}{p}" for h, p in urls]:
        host, p, rule, block = index.judge([u])[0]
        want = brute_judge(u, rules)
        assert (host, p, rule) == want[:3] and (rule is None or block == (want[3] == "block"))


def test_collisions_are_told_apart(tmp_path, monkeypatch):
    path = tmp_path / "rules.idx"
    monkeypatch.setattr(xxhash, "xxh64_intdigest", lambda b, *a: len(b) % 3)
    rules = [("block", f"h{i}.com/") for i in range(30)]
    path.write_bytes(urlfilter.build(rules))
    index = urlfilter.Index(str(path))
    assert np.all(np.diff(index.keys.astype(int)) >= 0)
    random.Random(1).shuffle(rules)
    assert all(index.judge([f"http://{r}x"])[0][2] == r for _, r in rules) and index.judge(["http://z9.com/"])[0][2] is None


def test_oracle(spark):
    duckdb.sql("CREATE OR REPLACE VIEW pages AS SELECT * FROM '/root/testdata/sf0.001/pages.parquet'")
    want = duckdb.sql(f"SELECT page_id, host, path, rule, verdict FROM ({urlfilter.ORACLE_SQL})").fetchall()
    assert sorted(tuple(r) for r in urlfilter.query(spark, "/root/testdata/sf0.001").collect()) == sorted(want)
