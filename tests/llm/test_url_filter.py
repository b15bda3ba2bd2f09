from llm_helpers import SF, check_oracle

from cartwheel.llm import url_filter as u

URLS = [
    ("http://a.example.net/en/1", "a.example.net", "/en/1", "example.net/en/", "allow"),
    ("http://example.net/en", "example.net", "/en", "net/", "block"),
    ("HTTPS://WWW.Example.COM/de/?x", "www.example.com", "/de/", "example.com/de/", "block"),
    ("http://notexample.com/de/x", "notexample.com", "/de/x", None, None),
    ("ftp://x.org/fr/a#b?c", "x.org", "/fr/a", "org/fr/", "allow"),
    ("http://org/FR/", "org", "/FR/", None, None),
    ("http://net/", "net", "/", "net/", "block"), ("http://net", "net", "", None, None),
    ("http://planet/", "planet", "/", None, None),
    (None, "", "", None, None), ("", "", "", None, None), ("no scheme/x", "", "", None, None),
    ("a://b://c/d", "b:", "//c/d", None, None), ("x://?q/r", "", "", None, None), ("http://É.Org/fr/", "É.org", "/fr/", "org/fr/", "allow"),
    ("http://line\nbreak/a\nb", "line\nbreak", "/a\nb", None, None),
]


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(k, x[0], "q", "w") for k, x in enumerate(URLS)], "page_id bigint, url string, host string, Url string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    got = {r.page_id: r for r in u.judge(pages, labels).collect()}
    assert len(got) == len(URLS)
    for k, (_, host, path, rule, verdict) in enumerate(URLS):
        r = got[k]
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict or "allow"), URLS[k]


def test_reputation_shrinks_and_blocks(spark):
    rows, labels = [], []
    for k in range(400):
        rows.append((k, f"http://{'bad' if k < 40 else f'good{k % 9}'}.site.io/x"))
        labels.append((k, int(k >= 40), 0))
    rows += [(900 + k, "http://new.site.io/x") for k in range(3)] + [(950, "http://bad.site.io/later"), (None, None), (950, "http://bad.site.io/later")]
    labels += [(960, None, 1), (961, None, None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    got = u.judge(pages, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")).collect()
    assert len(got) == len(rows)
    assert {r.host for r in got if r.verdict == "block"} == {"bad.site.io"}
    share = {r.host: r.share for r in got}
    assert share["good1.site.io"] < share["new.site.io"] < share["bad.site.io"] < 1


def judged(spark, rows):
    """{host: row} for (url, bad or None) pages."""
    pages = spark.createDataFrame([(k, x[0]) for k, x in enumerate(rows)], "page_id bigint, url string")
    labels = [(k, 0, 1) if x[1] else (k, 1, 0) for k, x in enumerate(rows) if x[1] is not None]
    got = u.judge(pages, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")).collect()
    assert len(got) == len(rows) and all(0 <= r.lower <= r.share <= 1 for r in got)
    return {r.host: r for r in got}


GOOD = [(f"http://fine{k}.example.fr/x", False) for k in range(200)]


def test_shared_suffixes_keep_owners_apart(spark):
    got = judged(spark, GOOD + [(f"http://bad{k % 40}.co.uk/{k}", True) for k in range(400)] + [("http://clean.co.uk/", None)])
    assert got["bad1.co.uk"].verdict == "block"
    assert got["clean.co.uk"].n_labelled == 0 and got["clean.co.uk"].verdict == "allow"


def test_ports_and_user_info_do_not_hide_a_site(spark):
    urls = ["http://bad.site.io:8080/x", "http://me:pw@bad.site.io/", "http://a@b@bad.site.io.:/", "http://BAD.site.io."]
    got = judged(spark, GOOD + [(f"http://bad.site.io/{k}", True) for k in range(30)] + [(x, None) for x in urls])
    for host in ("bad.site.io", "bad.site.io:8080", "me:pw@bad.site.io", "a@b@bad.site.io.:", "bad.site.io."):
        assert got[host].verdict == "block" and got[host].n_bad == 30, host


def test_addresses_are_domains_of_their_own(spark):
    got = judged(spark, GOOD + [(f"http://10.1.2.3:81/{k}", True) for k in range(40)] + [("http://10.9.2.3/", None), ("http://[::1]:8/", None)])
    assert got["10.1.2.3:81"].verdict == "block"
    assert got["10.9.2.3"].verdict == got["[::1]:8"].verdict == "allow" and got["10.9.2.3"].n_labelled == 0


def test_all_outcomes_alike(spark):
    """No spread to learn from: a site without a label is not blocked, one with many bad pages is."""
    got = judged(spark, [(f"http://bad{k % 4}.io/{k}", True) for k in range(80)] + [("http://new.io/", None), ("http://other.com/", None)])
    assert got["bad0.io"].verdict == "block"
    assert got["new.io"].verdict == got["other.com"].verdict == "allow"
    good = judged(spark, [(f"http://a{k}.io/", False) for k in range(50)])
    assert {r.verdict for r in good.values()} == {"allow"}
    one = judged(spark, [("http://only.io/", True)])
    assert one["only.io"].verdict == "allow"


def test_very_long_urls(spark):
    long = "a." * 100_000 + "io"
    got = judged(spark, [(f"http://{long}/{'p' * 500_000}", None), (f"http://{'@' * 100_000}x.io/", None), ("x" * 500_000, None)])
    assert len(got[long].path) == 500_001


def test_hierarchy_columns(spark):
    rows = spark.createDataFrame([(h,) for h in ("a.b.co.uk", "co.uk", "b.co.uk", "x.y.z.com", "com", "", "1.2.3.4", "1.2.3", "[::1]")], "h string")
    got = {r.h: (r.d, r.s) for r in rows.select("h", u.domain_of(rows["h"]).alias("d"), u.suffix_of(rows["h"]).alias("s")).collect()}
    assert got == {"a.b.co.uk": ("b.co.uk", "co.uk"), "b.co.uk": ("b.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "x.y.z.com": ("z.com", "com"),
                   "com": ("com", "com"), "": ("", ""), "1.2.3.4": ("1.2.3.4", "[]"), "1.2.3": ("2.3", "3"), "[::1]": ("[::1]", "[]")}


def test_sql_over_awkward_hosts(spark, tmp_path):
    """The independent SQL over hosts that the given pages do not have."""
    import duckdb
    from compare import compare
    rows = GOOD[:50] + [(f"http://{h}/p", bad) for h in (
        "bad.co.uk", "bad.co.uk:80", "x@bad.co.uk.", "1.2.3.4", "1.2.3.4:5", "[::1]:9", "new.co.uk", "github.io", "a.github.io", "", ":", "@", ".")
        for bad in (True, True, None, False)]
    pages = spark.createDataFrame([(k, x[0]) for k, x in enumerate(rows)], "page_id bigint, url string")
    labels = spark.createDataFrame([(k, int(not x[1]), int(x[1])) for k, x in enumerate(rows) if x[1] is not None], "doc_id bigint, quality int, toxic int")
    con = duckdb.connect()
    for name, df in (("pages", pages), ("labels", labels)):
        df.write.parquet(f"{tmp_path}/{name}")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}/*.parquet')")
    assert compare(u.judge(pages, labels), con, u.OP9_SQL) == []


def test_empty_tables(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string")
    labels = spark.createDataFrame([(1, 0, 1)], "doc_id bigint, quality int, toxic int")
    assert u.judge(pages, labels).count() == 0


def test_oracle(spark):
    check_oracle(spark, "op9_url_filter", SF)
