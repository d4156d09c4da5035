import duckdb
import pytest

from edgewise.llm import url_filter as U

SCHEMA = "page_id bigint, url string, host int, key string, ew_key string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, 7, "x", "y") for i, u in rows], SCHEMA)


def rules_of(url):
    """Host, path and the longest rule that fits, with plain string functions."""
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    best = None
    for said, rule in U.RULES:
        name, tail = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + tail):
            if best is None or len(rule) > len(best[0]):
                best = (rule, said)
    return (host, path, *(best or (None, None)))


CASES = [
    "http://a.example.net/en/1", "http://example.net/en/", "http://example.net/en", "http://xexample.net/en/1", "http://NET/", "http://net",
    "http://a.net?x=/", "https://EXAMPLE.com/de/1?x#y", "https://example.com/DE/1", "ftp://x.org/fr/", "http://x.org/fr", "http://org/fr/a/b",
    "http://é.org/fr/ü", "x://y://z.net/a", "no scheme net/", "://net/a", "", None, "http://a.net:80/", "http://u@a.example.com/de/#", "http://a.net#/x",
    "http://a.net\n/x", "data://" + "é𝄞ab" * 20_000, "http://a.net/ ", "HTTP://ORG/FR/", "http://a.org//fr/",
]


def test_hosts_paths_and_rules(spark):
    got = {r.page_id: r for r in U.url_report(pages(spark, list(enumerate(CASES)))).collect()}
    for i, url in enumerate(CASES):
        host, path, rule, said = rules_of(url)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), url
        assert got[i].verdict == said if said else got[i].verdict in ("allow", "block"), url


def test_the_models_equal_the_sql_with_repeats_and_null_ids(spark, tmp_path):
    words = ["alpha", "beta", "gamma", "delta", "pills", "bets"]
    rows = []
    for i in range(300):
        w = words[i * 7 % 6]
        rows.append((i, [f"http://{w}.example.net/en/{i}", f"https://{w}{i}.example.com/de/{i}.html", f"http://{w}.org/fr/{i}?a=1",
                         f"http://m.{w}.example.net/de/{i}", f"http://{w}.example.com/en/{i}", f"https://{w}.org/es/{i}/"][i % 6]))
    rows += [(None, "http://alpha.org/es/9"), (None, "http://beta.com/9"), (5, "http://one.com"), (5, "http://two.com"), (9, None), (10, ""), (11, "x")]
    rows += [(7000 + i, "http://hot.com/en/") for i in range(200)]  # one URL of very many rows
    df = spark.createDataFrame(rows, "page_id bigint, url string")
    df.coalesce(1).write.parquet(str(tmp_path / "p"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/p/*.parquet'")
    want = con.execute(U.ORACLE).fetchall()
    got = [tuple(r) for r in U.url_report(df).select("page_id", "host", "path", "rule", "verdict", "score").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert {r[4] for r in got if r[3] is None} == {"allow", "block"}
    # the same with next to nothing broadcast
    U_hot, U.HOT_GRAMS = U.HOT_GRAMS, 3
    try:
        assert sorted([tuple(r) for r in U.url_report(df).collect()], key=str) == sorted(got, key=str)
    finally:
        U.HOT_GRAMS = U_hot


def test_unruled_urls_like_the_rejected_ones_are_blocked(spark):
    """The threshold separates two kinds of made-up URLs that the rules do not name."""
    good = [f"http://{a}{b}.org/fr/{a}-notes-{b}" for a in ("paper", "garden", "school", "museum") for b in range(40)]
    bad = [f"http://{a}{b}.net/{a}-win-cash-{b}" for a in ("cheap", "casino", "bonus", "pills") for b in range(40)]
    new = [f"http://{a}.com/x/{a}-notes-{b}" for a in ("paper", "garden", "museum") for b in range(50, 60)] \
        + [f"http://{a}.com/x/{a}-win-cash-{b}" for a in ("cheap", "casino", "pills") for b in range(50, 60)]
    rows = list(enumerate(good + bad + new))
    got = {r.page_id: r.verdict for r in U.url_report(pages(spark, rows)).collect()}
    at = len(good) + len(bad)
    right = sum(got[at + i] == ("allow" if i < 30 else "block") for i in range(60))
    assert right >= 57


def test_filter_keeps_columns_rows_and_empty_tables(spark):
    rows = [(1, "http://a.net/"), (1, "http://a.org/fr/"), (None, "http://b.net/"), (2, "http://a.org/fr/"), (2, "http://a.org/fr/")]
    df = pages(spark, rows)
    kept = U.without_blocked(df)
    assert kept.columns == df.columns
    assert sorted((r.page_id, r.url) for r in kept.collect()) == [(1, "http://a.org/fr/"), (2, "http://a.org/fr/"), (2, "http://a.org/fr/")]
    empty = df.where("false")
    assert U.url_report(empty).collect() == [] and U.without_blocked(empty).collect() == []


def test_no_labels_at_all_and_too_many_rules(spark):
    got = U.url_report(pages(spark, [(1, "http://a.com/x"), (2, None)])).collect()
    assert {(r.page_id, r.verdict, r.score) for r in got} == {(1, "allow", 0), (2, "allow", 0)}
    with pytest.raises(ValueError):
        U.url_report(pages(spark, [(1, "x")]), [("block", f"h{i}/") for i in range(U.MAX_RULES + 1)])
