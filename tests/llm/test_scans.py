"""Licence, secret and URL scans against plain Python versions."""

import random
import re
from hashlib import sha256

import pytest

from obsflow.llm import license_scan, secret_scan, url_filter


def plain_licenses(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    phrases = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
    places = []
    for phrase, label in phrases.items():
        want = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(want)] == want]
    starts = [i for i, _ in places]
    labels = ",".join(sorted({label for _, label in places}))
    return len(words), len(places), min(starts, default=None), max(starts, default=None), labels


def noise(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


def test_licenses_base():
    rng, scanner = random.Random(3), license_scan.LicenseScanner()
    words = "cc by CC-BY general public License all rights reserved the x é version 3 of".split()
    for _ in range(3000):
        text = noise(rng, words, rng.randint(0, 30))
        assert scanner.summary(text)[:5] == plain_licenses(text), text


def plain_runs(scanner, words, sequences):
    """Longest run ending at each word that stands in a template."""
    joined = [" " + " ".join(w.decode() for w in s) + " " for s in sequences]
    out = []
    for end in range(1, len(words) + 1):
        best = 0
        for n in range(1, end + 1):
            run = " " + " ".join(w.decode() for w in words[end - n : end]) + " "
            if any(run in j for j in joined):
                best = n
            else:
                break
        if best:
            out.append((end, best))
    return out


def test_matching_statistics():
    rng, scanner = random.Random(4), license_scan.LicenseScanner()
    sequences = [license_scan.words_of(t) for t, _ in (*license_scan.PHRASES, *license_scan.TEMPLATES)]
    for _ in range(150):
        parts = []
        for _ in range(rng.randint(1, 4)):
            s = rng.choice(sequences)
            a = rng.randrange(len(s))
            parts += s[a : a + rng.randint(1, 12)] + [b"zz"] * rng.randint(0, 1)
        assert [(e, n) for e, n, _ in scanner.matches(parts) if n] == plain_runs(scanner, parts, sequences)


def test_license_spans():
    scanner = license_scan.LicenseScanner()
    mit = license_scan.TEMPLATES[5][0]
    n, places, first, last, base, labels, score, spans = scanner.summary(f"some words {mit.title()} more words")
    assert (places, base, labels, score) == (0, "", "mit", 1.0)
    assert spans == [(2, n - 2, "mit", 1.0)]
    broken = mit.split()
    broken[9:9] = ["inserted", "words"]
    assert scanner.summary(" ".join(broken))[5] == "mit"
    assert scanner.summary("permission is hereby granted")[5] == ""
    assert scanner.summary(f"{mit} . {mit}")[7][1][0] == len(mit.split())


def test_run_that_a_template_has_twice():
    template = "a b c d one two three four five a b c d six seven eight nine"
    scanner = license_scan.LicenseScanner(templates=((template, "x"),))
    found = scanner.summary("one two three four zz a b c d ZZ six seven eight nine")
    assert found[5] == "x" and found[7] == [(0, 14, "x", 12 / 17)]
    half = "one two three four five a b c d six"
    spans = scanner.summary(f"{template} {template} . {half} {template}")[7]
    assert spans == [(0, 17, "x", 1.0), (17, 34, "x", 1.0), (34, 44, "x", 10 / 17), (44, 61, "x", 1.0)]


def all_chains(runs, max_gap):
    """(covered, start, end) of every chain of runs, by trying each run after each."""
    grown = [((r,), r[1] - r[0]) for r in runs]
    out = []
    while grown:
        chain, covered = grown.pop()
        out.append((covered, chain[0][0], chain[-1][1]))
        _, end, to = chain[-1]
        for run in runs:
            if run[1] > end and run[2] > to and run[0] - end <= max_gap:
                grown.append(((*chain, run), covered + min(run[1] - run[0], run[1] - end, run[2] - to)))
    return out


def test_spans_are_best_chains():
    rng, several = random.Random(8), 0
    for _ in range(1500):
        template = [rng.choice("abcde") for _ in range(rng.randint(4, 14))]
        text = []
        for _ in range(rng.randint(1, 4)):
            at = rng.randrange(len(template))
            text += template[at : at + rng.randint(1, 9)] + ["z"] * rng.choice((0, 0, 1, 5))
        size, gap = rng.randint(2, 3), rng.randint(1, 4)
        scanner = license_scan.LicenseScanner((), ((" ".join(template), "x"),), size, 0.6, gap)
        places, ends = lambda run: [i + len(run) for i in range(len(template)) if template[i : i + len(run)] == run], {}
        for end in range(1, len(text) + 1):  # the longest run of the template that ends at each word
            ends[end] = max((n for n in range(end + 1) if places(text[end - n : end])), default=0)
        full = [(e - n, e) for e, n in ends.items() if n >= size and ends.get(e + 1, 0) != n + 1]
        runs = [(s, e, to) for s, e in full for to in places(text[s:e])]
        spans = scanner.scan(" ".join(text))[2]
        chains = all_chains(runs, gap)
        assert max((c for *_, c in spans), default=0) == max((c for c, _, _ in chains), default=0)
        if chains:
            most = max((c, s - e) for c, s, e in chains)
            assert most in [(c, s - e) for s, e, _, c in spans]
        assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))
        free = [r for r in full if all(max(r[0], s) >= min(r[1], e) for s, e, *_ in spans)]
        assert not free  # no run lies outside all spans
        several += len(spans) > 1
    assert several > 100


def test_many_copies_of_a_notice():
    scanner = license_scan.LicenseScanner()
    notice = license_scan.TEMPLATES[6][0]
    spans = [s for s in scanner.summary(f"{notice} " * 3000)[7] if s[2] == "apache"]
    assert len(spans) == 3000 and {s[3] for s in spans} == {1.0}


def test_licenses_edges(odd, none):
    rows = {r.doc_id: r for r in license_scan.scan_licenses(odd).collect()}
    assert license_scan.scan_licenses(odd).count() == 8 and license_scan.scan_licenses(none).count() == 0
    assert (rows[1].n_words, rows[1].first_word, rows[1].labels, rows[1].score) == (0, None, "", 0.0)
    assert rows[4].n_words == 30_000


def plain_secrets(text):
    found = []
    assign = r"((?i:password|passwd|secret|token|api_?key))[\"']? *[:=] *[\"']?([A-Za-z0-9+/_.=-]+)"
    found += [("assign", m.start(), m.end()) for m in re.finditer(assign, text, re.A) if len(m[2]) >= 6]
    found += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    kinds = [k for k, _, _ in found]
    order = sorted(found, key=lambda f: (f[1], ["assign", "access", "hex"].index(f[0])))
    joined = ",".join(f"{k}:{s}:{e}" for k, s, e in order)
    return kinds.count("assign"), kinds.count("access"), kinds.count("hex"), sha256(joined.encode()).hexdigest()


def test_secrets_base():
    rng = random.Random(5)
    parts = ["password", "PassWD", "secret", "ToKen", "api_key", "ſecret", "apikey", '"', "'", " ", "  ", ":", "=", "\n", "é",
             "abcdef", "abc", "AKIA", "AKIA" + "A1" * 8, "0a" * 12, "f" * 23, "x", "Kelvin", "toKen", "-", "."]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert secret_scan.summary(text)[:4] == plain_secrets(text), repr(text)


def test_weak_parts_need_complements():
    key = "Zm9vYmFyMTIzNDU2Nzg5MGFiY2RlZkdI"
    assert secret_scan.summary(f"lone {key} here")[4] == ""
    assert secret_scan.summary("see http://a.example/x here")[4] == ""
    near = f"user=alice {key} at https://a.example/x"
    assert [s.split(":")[0] for s in secret_scan.summary(near)[4].split(",")] == ["login", "key", "endpoint"]
    far = f"user=alice{' pad' * 100} {key}"
    assert secret_scan.summary(far)[4] == ""
    assert secret_scan.summary("token=abcdef0123 host 10.1.2.3")[4] == "assign:0:16,endpoint:22:30"


def test_keys_after_a_name():
    """A key stands after '=', ':' or in a query as well as after a space; padding is part of it."""
    key, access = "wJalrXUtnFEMI/K7MDENG/bPxRfiCYzzEXAMPLE1", "AKIA" + "A1" * 8
    forms = [f"AWS_SECRET_ACCESS_KEY={key}", f"sk:{key}", f"SK = {key}", f'"sk":"{key}"', f"GET /x?sig={key}&v=1"]
    for form in forms:
        text = f"AWS_ACCESS_KEY_ID={access}\n{form}"
        at = text.index(key)
        assert secret_scan.summary(text)[4] == f"access:18:38,key:{at}:{at + 40}", form
        assert secret_scan.summary(form)[4] == ""
    assert secret_scan.summary(f"{access} k={key}==")[4] == "access:0:20,key:23:65"


def test_overlapped_parts_complement():
    """A login or endpoint that holds a strong part is reported and complements a key; one within a strong part is not."""
    key, number = "wJalrXUtnFEMI/K7MDENG/bPxRfiCYzzEXAMPLE1", "0a" * 16
    spans = lambda text: secret_scan.summary(text)[4]
    assert spans(f"client_id={number} {key}") == "login:0:42,hex:10:42,key:43:83"
    assert spans(f"https://a.example/x?token=abcdef0 {key}") == "endpoint:0:33,assign:20:33,key:34:74"
    access = "AKIA" + "A1" * 8
    assert spans(f"https://a.example/x?sig={key}&id={access}") == "endpoint:0:88,key:24:64,access:68:88"
    assert spans(f"secret={key}") == "assign:0:47"
    assert spans(f"password=user=alice {key}") == "assign:0:19,key:20:60"


def test_outside_like_all_pairs():
    rng = random.Random(7)
    for _ in range(300):
        weak, strong = ([(a := rng.randint(0, 60), a + rng.randint(1, 20), k) for _ in range(6)] for k in ("key", "hex"))
        want = [p for p in weak if not any(q[0] <= p[0] and p[1] <= q[1] for q in strong)]
        assert secret_scan.outside(weak, strong) == want


def test_links_like_all_pairs():
    rng = random.Random(6)
    for _ in range(500):
        parts = [(a := rng.randint(0, 3000), a + rng.randint(1, 300), rng.choice(secret_scan.KINDS)) for _ in range(12)]
        weak = [p for p in parts if p[2] in secret_scan.COMPLEMENTS]
        strong = [p for p in parts if p[2] not in secret_scan.COMPLEMENTS]
        want = [
            p
            for p in weak
            if any(
                secret_scan.ROLE[q[2]] in secret_scan.COMPLEMENTS[p[2]] and q[0] <= p[1] + 200 and q[1] >= p[0] - 200
                for q in parts
            )
        ]
        assert secret_scan.linked(weak, strong) == want


def test_secrets_edges(odd, none):
    rows = secret_scan.scan_secrets(odd).collect()
    assert len(rows) == 8 and secret_scan.scan_secrets(none).count() == 0
    empty = sha256(b"").hexdigest()
    assert all((r.n_assign, r.base_sha256, r.spans) == (0, empty, "") for r in rows)


URLS = [
    ("http://WWW.Example.org/es/1?x#y", "www.example.org", "/es/1", "example.org/es/", "block"),
    ("https://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
    ("https://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
    ("https://notexample.org/es/2", "notexample.org", "/es/2", "org/", "allow"),
    ("x://a.com/fr/1#/de/", "a.com", "/fr/1", "com/fr/", "allow"),
    ("x://a.com/de/?q", "a.com", "/de/", "com/de/", "block"),
    ("x://org", "org", "", None, None),
    ("x://a.b?c://d/e", "a.b", "", None, None),
    ("://h\n/p\nq", "h\n", "/p\nq", None, None),
    ("no scheme", "", "", None, None),
    ("", "", "", None, None),
    (None, "", "", None, None),
]


def test_urls(spark):
    pages = spark.createDataFrame([(i, u[0], "clash") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    labelled = url_filter.rule_labels(pages)
    got = {r.page_id: r for r in url_filter.judge(pages, labelled).collect()}
    assert len(got) == len(URLS)
    for i, (_, host, path, rule, verdict) in enumerate(URLS):
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict in ("allow", "block") if verdict is None else got[i].verdict == verdict
    assert url_filter.judge(pages.where("false"), labelled).count() == 0
    unlabelled = url_filter.judge(pages, labelled.where("false")).collect()
    assert all(r.verdict == "allow" for r in unlabelled if r.rule is None)


def test_labels_of_repeated_urls(spark):
    """One URL holds a third of the rows, the others are there 50 times each, and one label is rare."""
    block = [f"https://s{i}.com/de/{i}?q={k}" for i in range(60) for k in range(50)]
    allow = ["https://a.org/fr/hot"] * 1500 + ["https://a.org/fr/other"] * 50
    asked = ["https://b.net/de/7", "https://c.net/fr/hot"]
    pages = spark.createDataFrame(list(enumerate([*block, *allow, *asked])), "page_id long, url string")
    labelled = url_filter.rule_labels(pages, rows=40).collect()
    assert sorted(r.label for r in labelled) == [0] * 38 + [1] * 2
    assert len({r.url.split("?")[0] for r in labelled}) == 40
    got = {r.page_id: r.verdict for r in url_filter.judge(pages, url_filter.rule_labels(pages, rows=40)).collect()}
    assert [got[len(block) + len(allow) + k] for k in (0, 1)] == ["block", "allow"]
    many = url_filter.rule_labels(pages)
    assert many.count() == 62 and many.groupBy("label").count().count() == 2


def test_url_model_learns(spark):
    rng = random.Random(8)
    rows = []
    for i in range(600):
        bad = rng.random() < 0.5
        word = rng.choice(["casino", "spam", "pills"] if bad else ["news", "docs", "wiki"])
        rows.append((f"http://{rng.choice('abcdef')}{i}.net/{word}/{rng.randint(1, 999)}", int(not bad)))
    labelled = spark.createDataFrame(rows[:300], "url string, label int")
    weights = url_filter.train(labelled)
    hosts, paths = zip(*[u[7:].split("/", 1) for u, _ in rows[300:]])
    found = url_filter.features(hosts, [f"/{p}" for p in paths])
    odds = url_filter.odds(weights, *found, 300)
    right = sum((o >= 0) == bool(label) for o, (_, label) in zip(odds, rows[300:]))
    assert right >= 290
    with pytest.raises(ValueError):
        url_filter.train(labelled, max_labelled=10)
