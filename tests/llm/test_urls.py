from fiscalake.llm import urls


def judged(frame, pages, labels, **more):
    p = frame(pages, "page_id bigint, url string")
    found = urls.judge_urls(p, frame(labels, "doc_id bigint, quality int, toxic int"), **more)
    return found


def test_hosts_paths_and_rules(frame):
    pages = [
        (1, "HTTP://WWW.Example.ORG/es/a?x"), (2, "http://example.org/en/12#t"), (3, "http://example.org?x=://y/"),
        (4, "https://a.b.com/fr/"), (5, "https://a.b.com/de/x"), (6, "https://b.net/de/"), (7, None), (8, "no scheme/"),
        (9, "http://"), (10, "http://notexample.org/es/"), (11, "http://ÄB.org/"), (11, "http://ÄB.org/"),
    ]
    got = {r.page_id: r for r in judged(frame, pages, []).collect()}
    assert [(got[k].host, got[k].path, got[k].rule, got[k].verdict) for k in range(1, 12)] == [
        ("www.example.org", "/es/a", "example.org/es/", "block"),
        ("example.org", "/en/12", "example.org/en/1", "block"),
        ("example.org", "", None, "allow"),
        ("a.b.com", "/fr/", "com/fr/", "allow"),
        ("a.b.com", "/de/x", "com/de/", "block"),
        ("b.net", "/de/", None, "allow"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("notexample.org", "/es/", "org/", "allow"),
        ("Äb.org", "/", "org/", "allow"),
    ]
    assert judged(frame, pages, []).count() == len(pages)


def test_reputation_shrinks_towards_the_domain(frame):
    pages = [(k, "http://bad.evil.net/x") for k in range(60)]
    pages += [(100 + k, f"http://h{k % 30}.fine.net/x") for k in range(120)]
    pages += [(500, "http://new.evil.net/"), (501, "http://new.fine.net/")]
    labels = [(k, 0, None) for k in range(60)] + [(100 + k, 1, 0) for k in range(120)]
    labels += [(3, 0, 1), (100, None, None)]
    got = {r.page_id: r for r in judged(frame, pages, labels).collect()}
    assert got[0].verdict == "block" and got[100].verdict == "allow"
    assert got[0].n_labelled == 60
    assert got[500].bad_mean > got[501].bad_mean
    assert 0 < got[501].bad_mean < got[500].bad_mean < got[0].bad_mean < 1


def test_no_rows(frame):
    assert judged(frame, [], []).count() == 0
