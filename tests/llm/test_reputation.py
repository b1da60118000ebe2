import pytest

from quire.llm import reputation as R

RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def pages(spark, urls):
    return spark.createDataFrame([(k, u, "x", "y", 1) for k, u in enumerate(urls)], "page_id long, url string, host string, name string, n int")


def outcomes(spark, rows):
    return spark.createDataFrame(rows, "page_id long, good boolean")


@pytest.mark.parametrize("url, host, path, rule, verdict", [
    ("http://WWW.Example.com/en/a?b#c", "www.example.com", "/en/a", "www.example.com/en/", "allow"),
    ("https://m.example.com/en/", "m.example.com", "/en/", "example.com/en/", "block"),
    ("https://example.com/de/x://y", "example.com", "/de/x://y", "com/", "allow"),
    ("https://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
    ("https://a.net/es/1", "a.net", "/es/1", "net/es/", "block"),
    ("https://a.net/esx", "a.net", "/esx", None, "allow"),
    ("https://a.com", "a.com", "", None, "allow"),
    ("https://a.com?x=/en/", "a.com", "", None, "allow"),
    ("no scheme", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow")])
def test_rules(spark, url, host, path, rule, verdict):
    r = R.judge(pages(spark, [url]), outcomes(spark, []), RULES).collect()[0]
    assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict)


def test_domains():
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F
    spark = SparkSession.getActiveSession()
    got = spark.createDataFrame([("a.b.co.uk",), ("b.co.uk",), ("x.y.org",), ("localhost",), ("",)], "h string").select(R.suffix_of(F.col("h")), R.domain_of(F.col("h"))).collect()
    assert [tuple(r) for r in got] == [("co.uk", "b.co.uk"), ("co.uk", "b.co.uk"), ("org", "y.org"), ("localhost", "localhost"), ("", "")]


def shrunk_by_hand(children, parent_mean):
    """(n, s) by name, and the mean above each: strength and posterior means."""
    told = [(n, s, parent_mean[c]) for c, (n, s) in children.items() if n]
    over = sum(n * (s / n - m) ** 2 - m * (1 - m) for n, s, m in told)
    room = sum((n - 1) * m * (1 - m) for n, _, m in told)
    rho = over / room if room else 0
    k = min(R.STRONGEST, max(R.WEAKEST, 1 / max(rho, 1e-9) - 1 if rho > 0 else R.STRONGEST))
    return k, {c: (k * parent_mean[c] + s) / (k + n) for c, (n, s) in children.items()}


def test_shrinkage_from_suffix_to_host(spark):
    urls, good = [], []
    for host, n, s in (("a.good.org", 40, 38), ("b.good.org", 5, 5), ("c.good.org", 1, 0), ("a.bad.org", 60, 6), ("b.bad.org", 2, 1), ("x.other.net", 30, 24), ("y.new.net", 0, 0)):
        for k in range(max(n, 1)):
            urls.append(f"http://{host}/{k}")
            good.append((len(urls) - 1, k < s if n else None))
    got = {r["host"]: r for r in R.reputations(pages(spark, urls), outcomes(spark, good)).collect()}
    hosts = {h: (r["n"], r["s"]) for h, r in got.items()}
    group = lambda cut: {key: tuple(map(sum, zip(*[v for h, v in hosts.items() if cut(h) == key]))) for key in {cut(h) for h in hosts}}
    domains, suffixes = group(lambda h: h.split(".", 1)[1]), group(lambda h: h.rsplit(".", 1)[1])
    n, s = map(sum, zip(*hosts.values()))
    _, ms = shrunk_by_hand(suffixes, dict.fromkeys(suffixes, (s + 1) / (n + 2)))
    _, md = shrunk_by_hand(domains, {d: ms[d.split(".")[1]] for d in domains})
    k, mh = shrunk_by_hand(hosts, {h: md[h.split(".", 1)[1]] for h in hosts})
    for h, r in got.items():
        assert r["mean"] == pytest.approx(mh[h]) and r["strength"] == pytest.approx(k)
    assert got["a.bad.org"]["bound"] < 0.5 < got["c.good.org"]["bound"]
    verdicts = {r["host"]: r["verdict"] for r in R.judge(pages(spark, urls), outcomes(spark, good)).collect()}
    assert verdicts["a.bad.org"] == "block" and verdicts["a.good.org"] == verdicts["y.new.net"] == "allow"


def test_awkward_rows(spark):
    p = pages(spark, ["http://a.org/1", "http://a.org/1", None])
    got = R.judge(p, outcomes(spark, [(0, True), (0, False), (None, True), (77, False), (1, None)])).collect()
    assert len(got) == 3
    assert R.judge(p.limit(0), outcomes(spark, [])).collect() == []
