"""URL templates and PII surrogates: rules, learnt templates, formats, coreference, distinctness, edge rows."""

import re

import pytest
from pyspark.sql import functions as F

from lectern.llm import pii_surrogates as pii
from lectern.llm import url_templates as urls


def test_host_and_path(spark):
    cases = [(None, "", ""), ("no scheme/x", "", ""), ("", "", ""), ("http://Www.Ä.ORG", "www.Ä.org", ""), ("a://b?x=/y", "b", ""),
             ("a://b#/y", "b", ""), ("a://b/c/d?e#f", "b", "/c/d"), ("a://b/c#d?e", "b", "/c"), ("://x/ y\nz", "x", "/ y\nz"), ("a://", "", ""), ("a://b://c/d", "b:", "//c/d")]
    got = urls.parsed(spark.createDataFrame([(u,) for u, _, _ in cases], "url string"), F.col("url")).collect()
    assert [(r.url, r.host, r.path) for r in got] == cases


def test_longest_rule_wins(spark):
    cases = {"a://x.org/": "org/", "a://org/": "org/", "a://x.org": None, "a://xorg/": None, "a://www.example.org/es/1": "example.org/es/",
             "a://example.org/en/12": "example.org/en/1", "a://myexample.org/es/": "org/", "a://b.com/fr/": "com/fr/", "a://b.com/fr": None}
    df = urls.parsed(spark.createDataFrame([(u,) for u in cases], "url string"), F.col("url"))
    got = df.select("url", urls.fitting_rule(F.col("host"), F.col("path")).alias("rule")).collect()
    assert {r.url: r.rule for r in got} == cases


@pytest.fixture(scope="module")
def site(spark):
    """One host whose /casino/<n> pages are bad, with variable numbers below languages that are alike."""
    rows, bad = [], []
    for i in range(400):
        kind = "casino" if i % 4 == 0 else ("en", "fr", "de")[i % 3]
        rows.append((i, f"https://site.test/{kind}/{i}/page{i}.html?q={i}", "other"))
        if i % 2 == 0:
            bad.append((i, 1 if kind == "casino" else 0))
    rows += [(900, None, "x"), (900, None, "x"), (901, "junk", "x"), (902, "a://deep.test/" + "/".join("abcdefghijk"), "x")]
    return spark.createDataFrame(rows, "page_id long, url string, template string"), spark.createDataFrame(bad + [(None, 1), (0, 0)], "page_id long, bad int")


def test_bad_branch_is_kept_apart_and_rejected(site):
    got = urls.filter_urls(*site).collect()
    assert len(got) == 404
    by = {r.page_id: r for r in got}
    assert {by[i].template for i in range(400)} == {"/casino/*/*", "/*/*/*"}
    assert all(by[i].verdict == ("block" if i % 4 == 0 else "allow") and by[i].rule is None for i in range(400))
    assert (by[900].host, by[900].template, by[900].verdict) == ("", "", "allow") and by[902].template == "/*" * 11


def test_branches_below_the_eighth_level(spark):
    """Bad and good subtrees part at level 9 and at level 18; paths of one depth that differ nowhere else share a template."""
    rows, bad = [], []
    for i in range(360):
        depth, kind = (8, 17)[i % 2], "bad" if i % 3 == 0 else "good"
        rows.append((i, f"https://d{depth}.test/" + "/".join(f"s{k}" for k in range(depth)) + f"/{kind}/{i}" + "/x" * (i % 5)))
        bad += [(i, int(kind == "bad"))] if i % 4 < 2 else []
    got = urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(bad, "page_id long, bad int")).collect()
    want = {i: ("/*" * (8, 17)[i % 2] + ("/bad" if i % 3 == 0 else "/*") + "/*" * (1 + i % 5), "block" if i % 3 == 0 else "allow") for i in range(360)}
    assert len(got) == 360 and {r.page_id: (r.template, r.verdict) for r in got} == want


def test_depths_are_judged_apart(spark):
    """Variable segments only: good paths have nine, bad ones twelve."""
    rows = [(i, "https://deep.test/" + "/".join(f"v{i}x{k}" for k in range(9 if i < 200 else 12))) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i >= 200)) for i in range(400)], "page_id long, bad int")
    got = urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string"), labels).collect()
    assert {(r.page_id >= 200, r.template, r.verdict) for r in got} == {(False, "/*" * 9, "allow"), (True, "/*" * 12, "block")}


def test_no_labels_and_no_pages(site):
    pages, labels = site
    assert {r.verdict for r in urls.filter_urls(pages, labels.limit(0)).collect()} == {"allow"}
    assert urls.filter_urls(pages.limit(0), labels).count() == 0


def test_rare_bad_section_of_a_hot_host_is_kept_apart(spark):
    """A third of all pages on a host of which 1 % is bad, a third on one of 40 equal sections of which one is."""
    rows, bad = [], []
    for i in range(6000):
        kind = "bad" if i % 100 == 0 else f"s{i % 7}"
        rows.append((i, f"https://hot.test/{kind}/{i}"))
        rows.append((10_000 + i, f"https://flat.test/s{i % 40}/{i}"))
        rows.append((20_000 + i, f"https://h{i % 50}.test/a/{i}"))
        if i % 4 in (0, 1):
            bad += [(i, int(kind == "bad")), (10_000 + i, int(i % 40 == 1)), (20_000 + i, int(i % 60 == 0))]
    got = urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(bad, "page_id long, bad int")).collect()
    assert len(got) == 18_000
    seen = {(r.host, r.path.split("/")[1] in ("bad", "s1"), r.template, r.verdict) for r in got if r.host == "flat.test"}
    assert seen == {("flat.test", True, "/s1/*", "block"), ("flat.test", False, "/*/*", "allow")}
    seen = {(r.path.startswith("/bad/"), r.template, r.verdict) for r in got if r.host == "hot.test"}
    assert seen == {(True, "/bad/*", "block"), (False, "/*/*", "allow")}


SAMPLES = {
    "..dots@mail1.example.com and -dash_x@y.org, éaccent@z.net;": 3,
    "mail a.b-1@mail5.example.com. THAT.92@MAIL2.EXAMPLE.COM###": 2, "+1 (743) 555-3824, (+44 20 7946 0958)": 2,
    "card 4994226020900891 4994-2260-2090-0891 9870157079875996": 2, "ip 70.23.22.57, 300.1.1.1 1.2.3.4.5 v1.2": 1,
    'token = "2321bac4d15ec8f9" API_KEY: \'AbC123defGHI456jkl\'': 2, "Mr. John Smith met Frau Müller; г-жа Анна Петрова, mr x, Dr who": 5,
    "plain text of 1234567890123456 and 12.5 % at 10:30, see 2024-01-01 @home": 0,
}


def test_mentions_of_names_and_national_formats():
    new, n = pii.replace_entities("Smith wrote. Mr. John Smith came. Smith's son and JOHN left; smith, Smithson and x.smith@a.org stay", "k", {})
    assert n == 6 and not re.search(r"\bSmith\b|John|JOHN|x\.smith", new) and "smith, Smithson and" in new
    w = re.findall(r"[A-Z]\w+", new)
    assert w[0] == w[3] == w[4] and new.split("'s son")[0].endswith(w[0]) and w[5] == w[2].upper()
    for text in ("(743) 555-3824", "020 7946 0958", "743-555-3824", "743.555.3824", "030 123 4567", "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"):
        new, n = pii.replace_entities(f"call {text}, THAT is all", "k", {})
        got = new[len("call "):-len(", THAT is all")]
        assert n == 1 and got != text and shape(got) == shape(text) and pii.replace_entities(f"call {got}, THAT", "k", {})[1] == 1
    iban = pii.entities("DE89 3704 0044 0532 0130 00 THAT WAS")
    assert [(e[1], e[2]) for e in iban] == [(27, "iban")] and pii._remainder(pii.surrogate("iban", iban[0][3], 0, "k")) == 1
    for text in ("DE88 3704 0044 0532 0130 00", "2024-01-01 10:30", "1743-555-3824", "743-555-38245", "743-555-3824-1", "12 345 6789", "0.5 123 4567", "v743.555.3824"):
        assert pii.replace_entities(text, "k", {}) == (text, 0), text


def test_rewrite_equals_a_plain_loop(spark):
    """The whole operator against a loop over all texts: entities of the corpus first, then collisions, then texts."""
    from tests.llm.conftest import make
    texts = [f"Mr. Al Bo{chr(97 + i % 7)} wrote to {chr(97 + i % 20)}@{chr(97 + i % 9)}.de, Bo{chr(97 + i % 7)} called 743-555-{1000 + i}" for i in range(300)] + [None, ""]
    found = sorted({(k, v) for t in texts for _, _, k, v in pii.entities(t)})
    settled, todo, attempt = {}, found, 0
    while todo:
        used = {(k, s) for (k, _), (s, _) in settled.items()} | set(found)
        best = {}
        for k, v in todo:
            s = pii.surrogate(k, v, attempt, "key")
            if (k, s) not in used:
                best[k, s] = min(v, best.get((k, s), v))
        settled |= {(k, v): (s, attempt) for (k, s), v in best.items()}
        todo, attempt = [e for e in todo if e not in settled], attempt + 1
    redrawn = {e: a for e, (_, a) in settled.items() if a}
    assert redrawn and len({(k, s) for (k, _), (s, _) in settled.items()}) == len(found)
    got = {r.doc_id: (r.text, r.n_entities) for r in pii.pseudonymise(make(spark, [(i, t, "en", "s") for i, t in enumerate(texts)]), "key").collect()}
    assert got == {i: pii.replace_entities(t, "key", redrawn) for i, t in enumerate(texts)}


def shape(text):
    return re.sub(r"[^\W\d_]", lambda m: "A" if m.group().isupper() else "a", re.sub(r"\d", "9", text))


@pytest.mark.parametrize("text", SAMPLES)
def test_format_and_type_are_kept(text):
    new, n = pii.replace_entities(text, "k", {})
    assert n == SAMPLES[text] and (new == text) == (n == 0)
    old_, new_ = pii.entities(text), pii.entities(new)
    assert [e[2] for e in old_] == [e[2] for e in new_]
    for a, b in zip(old_, new_):
        assert a[3] != b[3]
        before, after = text[a[0]:a[1]], new[b[0]:b[1]]
        if a[2] in ("email", "phone", "card", "secret"):
            assert len(before) == len(after) and (shape(before) == shape(after) or a[2] in ("secret", "email"))
        if a[2] == "card":
            assert pii.luhn(b[3]) and before[0] == after[0]
        if a[2] in ("given", "family"):
            assert pii._script(before) == pii._script(after) and after[0].isupper() and a[3].rpartition(":")[0] == b[3].rpartition(":")[0]


def test_names_keep_gender_endings_and_families():
    new, _ = pii.replace_entities("Mr. John Smith, Mrs. Smith, Mrs. Jane Smith, Mr. Jane Doe", "k", {})
    words = re.findall(r"(Mrs?)\. (\w+)(?: (\w+))?", new)
    assert words[0][2] == words[1][1] == words[2][2]
    assert words[2][1].endswith("a") and not words[3][1].endswith("a")


def test_coreference_keys_and_rows(spark, edge, empty):
    from tests.llm.conftest import make
    docs = make(spark, [(1, "x a.b@c.de y A.B@C.DE", "en", "s"), (1, "x a.b@c.de y A.B@C.DE", "en", "s"), (2, "z a.b@c.de", "en", "s"), (3, None, "en", "s"), (4, "", "en", "s")])
    got = pii.pseudonymise(docs, "k1").collect()
    found = {m.lower() for r in got for m in re.findall(r"\S+@\S+", r.text or "")}
    assert len(got) == 5 and len(found) == 1 and found != {"a.b@c.de"} and got[0].text == got[1].text
    assert sorted((r.doc_id, r.n_entities) for r in got) == [(1, 2), (1, 2), (2, 1), (3, 0), (4, 0)]
    assert list(got[0].asDict()) == [c for c in docs.columns if c != "n_entities"] + ["n_entities"]
    other = {m.lower() for r in pii.pseudonymise(docs, "k2").collect() for m in re.findall(r"\S+@\S+", r.text or "")}
    assert other != found
    clean = pii.pseudonymise(edge, "k")
    assert clean.select("doc_id", "text").exceptAll(edge.select("doc_id", "text")).count() == 0
    assert pii.pseudonymise(empty, "k").count() == 0


def test_collisions_are_drawn_again(spark):
    """One-letter mail names have few surrogates: all must stay distinct, and none may be another's original."""
    from tests.llm.conftest import make
    names = [f"{a}@{b}.de" for a in "abcdefghijklmnopqrst" for b in "abcdefghij"]
    docs = make(spark, [(i, f"to {m}, {m}", "en", "s") for i, m in enumerate(names)])
    got = {r.doc_id: re.findall(r"\S+@\S+\.de", r.text) for r in pii.pseudonymise(docs, "k").collect()}
    assert all(len(set(v)) == 1 for v in got.values())
    new = [v[0] for v in got.values()]
    assert len(set(new)) == len(names) and not set(new) & set(names)


def test_a_full_format_is_widened(spark):
    from tests.llm.conftest import CLASHES, make
    rows = [(26 * a + b, f"mail {chr(97 + a)}@{chr(97 + b)}.de now", "en", "s") for a in range(26) for b in range(26)]
    docs = make(spark, rows)
    out = pii.pseudonymise(docs)
    assert out.columns == [c for c in docs.columns if c != "n_entities"] + ["n_entities"]
    new = {r.doc_id: r.text for r in out.collect()}
    old = {t for _, t, _, _ in rows}
    assert len(new) == 676 == len(set(new.values())) and not set(new.values()) & old
    assert all(re.fullmatch(r"mail [a-z]+@[a-z]+\.de now", t) for t in new.values())
    assert all([r[c] for c in CLASHES] == CLASHES for r in out.limit(5).collect())


def test_secrets_keep_case_and_stay_apart(spark):
    from tests.llm.conftest import make
    one = "AbCdEfGh12345678XYZa"
    rows = [(1, f'token = "{one}"', "en", "s"), (2, f'token = "{one.lower()}"', "en", "s")]
    a, b = (r.text for r in pii.pseudonymise(make(spark, rows)).orderBy("doc_id").collect())
    x, y = a.split('"')[1], b.split('"')[1]
    shape = lambda s: "".join("A" if c.isupper() else "a" if c.islower() else "0" for c in s)
    assert shape(x) == shape(one) and shape(y) == shape(one.lower()) and x.lower() != y
