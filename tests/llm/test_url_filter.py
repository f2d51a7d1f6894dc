import pytest

from wardflow.llm import url_filter as uf

PAGES, LABELS = "page_id long, url string", "doc_id long, quality int, toxic int"


def judged(spark, urls, labels=(), rules=uf.RULES):
    pages = spark.createDataFrame(list(enumerate(urls)), PAGES)
    found = uf.filter_urls(pages, spark.createDataFrame(list(labels), LABELS), rules)
    return sorted(found.collect(), key=lambda r: r["page_id"])


def test_hosts_paths_and_rules(spark):
    cases = [
        ("HTTP://WWW.Example.COM/en/x?q#f", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
        ("https://a.example.com/en/1", "a.example.com", "/en/1", "example.com/en/", "block"),
        ("https://example.com/de/1", "example.com", "/de/1", "com/", "allow"),
        ("https://notexample.com/en/1", "notexample.com", "/en/1", "com/", "allow"),
        ("https://x.net/es/1", "x.net", "/es/1", "net/es/", "block"),
        ("https://x.net/fr", "x.net", "/fr", None, "allow"),
        ("https://x.com?y=/z", "x.com", "", None, "allow"),
        ("x://ÄB.net#/es/", "Äb.net", "", None, "allow"),
        ("a://b://net/es/1", "b:", "//net/es/1", None, "allow"),
        ("no address", "", "", None, "allow"),
        ("", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("http://" + "a" * 100_000 + ".net/fr/" + "b" * 100_000, "a" * 100_000 + ".net", "/fr/" + "b" * 100_000, "net/fr/", "block"),
    ]
    found = judged(spark, [c[0] for c in cases])
    assert [tuple(r)[1:5] for r in found] == [c[1:] for c in cases]


def test_longest_rule_wins(spark):
    rules = (uf.AddressRule("allow", "a.net", "/"), uf.AddressRule("block", "net", "/long/path/"), uf.AddressRule("allow", "net", "/es/"),
             uf.AddressRule("block", "net", "/es/"))
    found = judged(spark, ["x://a.net/long/path/1", "x://a.net/long", "x://b.net/es/1"], rules=rules)
    assert [r["verdict"] for r in found] == ["block", "allow", "block"]


def test_reputation_follows_the_evidence(spark):
    urls, labels = [], []
    for host, n, bad in (("bad.one.org", 60, 58), ("few.two.org", 2, 2), ("good.two.org", 80, 2), ("ok.three.net", 100, 10)):
        for i in range(n):
            number = len(urls)
            urls.append(f"http://{host}/de/{number}.html?x")
            labels.append((number, 0 if i < bad else 1, None))
    urls += ["http://new.one.org/de/none", "http://other.four.org/de/"]
    found = {r["host"]: r for r in judged(spark, urls, labels)}
    assert found["bad.one.org"]["verdict"] == "block"
    assert {found[h]["verdict"] for h in ("few.two.org", "good.two.org", "ok.three.net", "other.four.org")} == {"allow"}
    assert found["few.two.org"]["bad_share"] < 1 and found["few.two.org"]["bad_share"] > found["good.two.org"]["bad_share"]
    assert found["new.one.org"]["bad_share"] > found["other.four.org"]["bad_share"]


def brute_force(counts):
    """Posterior shares by host from {host: (labelled, bad)}, all hosts with two labels under one suffix level."""
    def shrink(groups, parents, of):
        known = {k: v for k, v in groups.items() if v[0]}
        totals = {}
        for k, (n, b) in known.items():
            t = totals.setdefault(of(k), [0, 0, 0])
            t[0], t[1], t[2] = t[0] + n, t[1] + b, t[2] + n * n
        n_all, k, p = sum(n for n, _ in known.values()), len(known), len(totals)
        weight = uf.MOST_WEIGHT
        if n_all > k > p:
            between = sum(n * (b / n - totals[of(g)][1] / totals[of(g)][0]) ** 2 for g, (n, b) in known.items()) / (k - p)
            within = sum(n * (b / n) * (1 - b / n) for n, b in known.values()) / (n_all - k)
            size = (n_all - sum(t[2] / t[0] for t in totals.values())) / (k - p)
            rho = (between - within) / (between + (size - 1) * within)
            if rho > 0:
                weight = min(max(1 / rho - 1, uf.LEAST_WEIGHT), uf.MOST_WEIGHT)
        return {g: (b + weight * parents[of(g)]) / (n + weight) for g, (n, b) in groups.items()}

    def rolled(groups, of):
        out = {}
        for g, (n, b) in groups.items():
            a = out.get(of(g), (0, 0))
            out[of(g)] = a[0] + n, a[1] + b
        return out

    domain, suffix = lambda h: ".".join(h.split(".")[-2:]), lambda d: d.split(".")[-1]
    domains = rolled(counts, domain)
    suffixes = rolled(domains, suffix)
    n, b = map(sum, zip(*counts.values()))
    top = shrink(suffixes, {"": (b + 0.5) / (n + 1)}, lambda s: "")
    return shrink(counts, shrink(domains, top, suffix), domain)


def test_posterior_equals_brute_force(spark):
    counts = {f"h{i}.d{i % 5}.{('org', 'net')[i % 2]}": (5 + 7 * i % 40, (3 * i) % 5) for i in range(30)}
    counts["zero.d9.org"] = 0, 0
    urls, labels = ["http://zero.d9.org/"], []
    for host, (n, bad) in counts.items():
        for i in range(n):
            labels.append((len(urls), 1, 1 if i < bad else 0))
            urls.append(f"http://{host}/x/{len(urls)}/")
    want = brute_force(counts)
    for row in judged(spark, urls, labels):
        assert row["bad_share"] == pytest.approx(want[row["host"]], abs=1e-12)


def test_registered_domains(spark):
    hosts = {"a.b.co.uk": ("b.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "u@x.y.org:80": ("y.org", "org"),
             "10.0.0.1": ("10.0.0.1", ""), "local": ("local", "local"), "": ("", ""), "a.b.c": ("b.c", "c")}
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    found = df.select("host", *uf.registered(df["host"])).collect()
    assert {r[0]: (r[1], r[2]) for r in found} == hosts


def test_repeats_null_labels_no_rows_and_clashing_columns(spark):
    labels = spark.createDataFrame([(1, None, None), (None, 0, 1), (2, 0, None), (2, 1, 0)], LABELS)
    pages = spark.createDataFrame([(1, "http://a.org/1", "x", 2)] * 2 + [(None, "http://a.org/2", "y", 3)], PAGES + ", host string, doc_id long")
    rows = uf.filter_urls(pages, labels).collect()
    assert [r["page_id"] for r in rows].count(1) == 2 and len(rows) == 3
    known = uf.page_outcomes(pages, labels).collect()
    assert [(r["pages"], r["labelled"], r["bad"]) for r in known] == [(3, 1, 1)]
    assert uf.filter_urls(pages.limit(0), labels).count() == 0 and uf.filter_urls(pages, labels.limit(0)).count() == 3
