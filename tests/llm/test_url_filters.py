import random
import re
from collections import defaultdict

import duckdb
import pytest

from evenhand.llm import queries
from evenhand.llm import url_filters as U

RULES = [U.Rule.of(x) for x in ("allow com/", "block example.com/en/", "allow www.example.com/en/", "block net/es/", "block net/fr/")]
ODD = [None, "", "no scheme", "://", "http://", "HTTP://User@WWW.Example.COM:80/en/a?x=http://b.net/es/", "http://example.com", "http://example.com?/en/", "http://example.com#/en/", "http://net/es/1", "http://a.net/es",
       "http://a.net/es/", "http://notnet/es/1", "http://xexample.com/en/1", "http://a.www.example.com/en/1", "a\n://ex.net/fr/\n1?q", "x://y://z.net/es/", "http://ÄÖ.Net/es/é", "http://h/" + "a/" * 3000 + "?q", "http://h//1//*/{a|b}/"]


def plain_parse(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
    return host.translate(str.maketrans(U.UPPER, U.LOWER)), path


def plain_rule(host, path, rules):
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return min(fits, key=lambda r: (-len(r.name), r.allow), default=None)


def plain_verdicts(rows, rules, s=U.Settings()):
    """The whole tree in memory; rows are (url, good or None)."""
    parsed = [plain_parse(u) for u, _ in rows]
    fit = [plain_rule(h, p, rules) for h, p in parsed]
    label = [f.allow if f else good for f, (_, good) in zip(fit, rows, strict=True)]
    trees = [re.sub(U.VARIABLE, "#", p).split("/")[1:] for _, p in parsed]
    for level in range(s.levels):
        nodes = defaultdict(lambda: defaultdict(list))
        for k, t in enumerate(trees):
            if len(t) > level:
                nodes[parsed[k][0], tuple(t[:level])][t[level]].append(k)
        for children in nodes.values():
            total = sum(map(len, children.values()))
            named = defaultdict(list)
            for segment, ks in children.items():
                named["#*" if len(children) > s.fanout and len(ks) < s.common * total else segment] += ks
            counts = {x: (sum(label[k] is True for k in ks), sum(label[k] is False for k in ks)) for x, ks in named.items()}
            clusters, before = [], None
            for x in sorted((x for x in named if sum(counts[x]) >= s.evidence), key=lambda x: (counts[x][1] / sum(counts[x]), x)):
                (g, b), n = counts[x], sum(counts[x])
                if before is not None:
                    m = sum(before)
                    apart = (b * m - before[1] * n) ** 2 * (n + m) > s.chi_square * (b + before[1]) * (g + before[0]) * n * m
                if before is None or apart:
                    clusters.append([])
                clusters[-1].append(x)
                before = counts[x]
            into = {x: "#{" + "|".join(sorted(c)) + "}" for c in clusters if len(c) > 1 for x in c}
            for x, ks in named.items():
                for k in ks:
                    trees[k][level] = into.get(x, x)
    sums = defaultdict(lambda: [0, 0])
    for (h, _), t, x in zip(parsed, trees, label, strict=True):
        if x is not None:
            sums[h, tuple(t)][not x] += 1
    out = []
    for (h, p), t, f in zip(parsed, trees, fit, strict=True):
        good, bad = sums[h, tuple(t)]
        verdict = f.allow if f else not (bad + 1) / (good + bad + 2) >= s.reject
        out.append((h, p, f.name if f else None, "/" + "/".join(t), good + bad, bad, "allow" if verdict else "block"))
    return out


def answers(df):
    return sorted((tuple(r["url_filter"]) for r in df.collect()), key=str)


def sample(seed, n=900):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        kind = rng.choice(["promo", "news", "tag", "user", "shop", "x%d" % rng.randrange(200), "y%s" % rng.choice("abcdefghijklmnopqrstuvwxyz")])
        url = f"http://{rng.choice('AAAbc')}.{rng.choice(['org', 'com', 'net'])}/{kind}/{rng.choice(['', 'p', 'q', str(rng.randrange(9999)), 'deadbeef' * 3])}"
        url += rng.choice(["", "/", f"/{rng.choice('abcdefghijklmnopqrstuvwxyz')}{rng.choice('abcdefghijklmnopqrstuvwxyz')}.html", "?a=1", "/s/t/u/v/w/x/y/z/1/2"])
        good = None if rng.random() < 0.4 else rng.random() < {"promo": 0.03, "tag": 0.05, "shop": 0.5}.get(kind, 0.95)
        rows.append((url, good))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_a_tree_in_memory(spark, seed):
    rows = sample(seed) + [(u, None) for u in ODD] * 2
    df = spark.createDataFrame(rows, "url string, good boolean").repartition(5)
    want = plain_verdicts(rows, RULES)
    assert answers(U.judged(df, rules=RULES, label="good")) == sorted(want, key=str)
    blocked = [w for w in want if w[2] is None and w[6] == "block"]
    assert blocked and any("#*" in w[3] for w in want) and any("#{" in w[3] for w in want)


def test_sql_agrees_on_odd_urls(spark, tmp_path):
    rows = [(k, u) for k, u in enumerate(ODD + [u for u, _ in sample(4, 400)])]
    spark.createDataFrame(rows, "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    found = queries.op11_url_filters(spark, str(tmp_path))
    want = con.sql(queries.SQL["op11_url_filters"]).project(", ".join(found.columns)).fetchall()
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)


def test_unlabelled_branches_inherit_nothing(spark):
    rows = [("http://h.org/bad/1", False)] * 5 + [("http://h.org/worse/2", False)] * 5 + [("http://h.org/new/3", None), ("http://h.org/bad/77", None)]
    got = {r["url"]: r["url_filter"] for r in U.judged(spark.createDataFrame(rows, "url string, good boolean"), label="good").collect()}
    assert got["http://h.org/new/3"]["verdict"] == "allow" and got["http://h.org/new/3"]["labelled"] == 0
    assert got["http://h.org/bad/77"]["verdict"] == "block" and got["http://h.org/bad/77"]["template"] == "/#{bad|worse}/#"


def test_rules(spark):
    tied = [U.Rule.of("allow b.com/xy"), U.Rule.of("block com/xyab")]
    assert U.Rule.of("block NET/Es/").name == "net/Es/"
    for line in ("allow com", "deny com/", "com/"):
        with pytest.raises(ValueError):
            U.Rule.of(line)
    same = [U.Rule.of("allow a.com/"), U.Rule.of("block a.com/")]
    df = spark.createDataFrame([("http://a.com/",), ("http://b.com/xyabc",)], "url string")
    for order in (same + tied, (same + tied)[::-1]):
        got = {r["url"]: r["url_filter"]["verdict"] for r in U.judged(df, rules=order).collect()}
        assert got == {"http://a.com/": "block", "http://b.com/xyabc": "block"}


def test_other_columns_and_empty_tables(spark):
    df = spark.createDataFrame([(u, 1, "x") for u in ODD], "url string, t_host int, url_filter string")
    got = U.judged(df, rules=RULES)
    assert got.columns == ["url", "t_host", "url_filter"] and got.count() == len(ODD)
    assert U.judged(df, out="host", rules=RULES).columns == ["url", "t_host", "url_filter", "host"]
    assert U.judged(df.filter("false"), rules=RULES).collect() == []


def test_heavy_and_light_leaves(spark, monkeypatch):
    monkeypatch.setattr(U, "HEAVY", 20)
    rows = sample(7, 300) + [("http://hot.org/a/1", None)] * 200
    want = plain_verdicts(rows, RULES)
    assert answers(U.judged(spark.createDataFrame(rows, "url string, good boolean"), rules=RULES, label="good")) == sorted(want, key=str)


def test_native_plan(spark):
    found = U.judged(spark.createDataFrame([(u,) for u in ODD], "url string"), rules=RULES)
    text = found._jdf.queryExecution().toString()
    assert "Python" not in text and "InPandas" not in text
