from obsmatch.llm import op05_urls as op

LABELS = "doc_id bigint, quality int, toxic int"
PAGES = "page_id bigint, url string, host int, verdict string"


def judge(llm, urls, labels=()):
    pages = llm.createDataFrame([(k, u, 1, "x") for k, u in enumerate(urls)], PAGES)
    return {r["page_id"]: r for r in op.filter_urls(pages, llm.createDataFrame(list(labels), LABELS)).collect()}


def test_hosts_paths_and_rules(llm):
    cases = [
        ("https://A.Example.ORG/es/1?x#y", "a.example.org", "/es/1", "example.org/es/", "block"),
        ("http://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
        ("http://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
        ("http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
        ("http://x.com/fr/a", "x.com", "/fr/a", "com/fr/", "allow"),
        ("http://x.com/de/a", "x.com", "/de/a", "com/de/", "block"),
        ("http://x.com/DE/a", "x.com", "/DE/a", None, "allow"),
        ("http://example.org", "example.org", "", None, "allow"),
        ("http://example.org?q=http://b.com/de/", "example.org", "", None, "allow"),
        ("a/b#http://É.com:80/ä ö", "É.com:80", "/ä ö", None, "allow"),
        ("example.org/es/", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("", "", "", None, "allow"),
        ("://", "", "", None, "allow"),
    ]
    got = judge(llm, [c[0] for c in cases])
    assert [(r["host"], r["path"], r["rule"], r["verdict"]) for _, r in sorted(got.items())] == [c[1:] for c in cases]


def test_bad_templates_are_rejected_and_good_ones_kept(llm):
    urls = [f"http://h.net/{'spam' if k % 2 else 'news'}/{k}.html" for k in range(200)] + [f"http://h.net/tags/t{k}" for k in range(100)]
    labels = [(k, 0 if k % 2 else 1, 0) for k in range(100)] + [(None, 0, 0), (0, 1, 0)]
    got = judge(llm, urls, labels)
    assert {got[k]["verdict"] for k in range(1, 200, 2)} == {"block"}
    assert {got[k]["verdict"] for k in range(0, 200, 2)} == {"allow"}
    assert got[0]["template"].startswith("/news/") and len({got[k]["template"] for k in range(0, 200, 2)}) == 1
    assert len({got[k]["template"] for k in range(200, 300)}) == 1


def test_wildcards_and_depth(llm):
    got = judge(llm, ["http://a.b/2020-01-02/" + "f" * 40 + "/12/x1y2z3/q", "http://a.b/" + "/".join("abcdefghij"), "http://a.b/" + "x" * 100_000])
    assert got[0]["template"] and got[1]["template"].count("/") == op.LEVELS + 1 and len(got) == 3
    pages = llm.createDataFrame([], PAGES)
    assert op.filter_urls(pages, llm.createDataFrame([], LABELS)).collect() == []


def test_a_small_section_keeps_its_verdict_whatever_the_number_of_its_siblings(llm):
    """A section of 4 % that is all bad in a good host, or all good in a bad one, with 16 and with 19 siblings."""
    urls, labels = [], []
    for host, rest in (("good", 1), ("bad", 0)):
        for siblings in (15, 19):
            for j in range(500):
                odd = j % 25 == 0
                urls.append(f"http://{host}{siblings}.net/{'odd' if odd else f'part{chr(97 + j % siblings)}'}/p{chr(97 + j % 7)}.html")
                labels.append((len(urls) - 1, 1 - rest if odd else rest, 0))
    got = judge(llm, urls, labels)
    for k, quality, _ in labels:
        assert got[k]["verdict"] == ("allow" if quality else "block"), (urls[k], got[k])


def test_long_segments_keep_their_own_verdict(llm):
    """Two sections whose names have 60 letters, one bad: a segment's length alone makes no wildcard of it."""
    good, bad = "an-article-about-good-things-" * 2 + "xx", "an-advert-that-looks-like-them-" * 2
    urls = [f"http://l.net/{bad if k % 2 else good}/p{k}.html" for k in range(100)]
    got = judge(llm, urls, [(k, 1 - k % 2, 0) for k in range(100)])
    assert {got[k]["verdict"] for k in range(0, 100, 2)} == {"allow"} and {got[k]["verdict"] for k in range(1, 100, 2)} == {"block"}


def test_deep_paths_are_told_apart(llm):
    top = "/".join("abcdefgh")
    urls = [f"http://d.net/{top}/{'spam' if k % 2 else 'news'}/x/{k}" for k in range(60)]
    urls += ["http://e.net/" + "/".join(["s"] * 3_000), f"http://d.net/{top}", "http://e.net/" + "/".join(["s"] * 3_000 + ["t"])]
    got = judge(llm, urls, [(k, 1 - k % 2, 0) for k in range(60)])
    assert {got[k]["verdict"] for k in range(0, 60, 2)} == {"allow"} and {got[k]["verdict"] for k in range(1, 60, 2)} == {"block"}
    assert len(got) == 63 and got[60]["template"] != got[62]["template"] != got[61]["template"]
    assert got[0]["template"].startswith("/a/b/c/d/e/f/#g#h#news#x#")
