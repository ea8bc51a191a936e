"""Personal data and urls, against regular expressions and a plain tree."""

from __future__ import annotations

import hashlib

import brute
import pytest
from compare import connect, differences
from hypothesis import given, settings
from hypothesis import strategies as st

from tenantflow.llm import pii, queries, url_templates
from tenantflow.llm.oracle import LLM_ORACLE

FOLDER = "/root/testdata/sf0.01"


def joined(found, kinds=pii.BASE_KINDS):
    return pii._joined(found, kinds)


@settings(max_examples=1500, deadline=None)
@given(
    st.one_of(
        st.text(alphabet="a1.@-+ ", max_size=30),
        st.text(alphabet="0123456789 -", max_size=60),
        st.text(alphabet="0125.", max_size=30),
        st.text(alphabet="+0123 ().-", max_size=40),
        st.lists(st.sampled_from(["a.b@c.de", "@", "4111 1111 1111 1111", "4111-1111-1111-1112", "1.2.3.4", "256.1.1.1",
                                  "+1 (555) 010-9999", "+12", " ", "é", "İ", "://u:p@h", ".", "5"]), max_size=8).map("".join),
    )
)
def test_base_spans_are_the_matches_of_the_patterns(text):
    assert joined(pii.AnchorScanner().scan(text)) == brute.base_spans(text)


@pytest.mark.parametrize(
    ("text", "spans"),
    [
        ("see https://bob:pw1@host.org/x", "email:16:28,login:12:19"),
        ("IBAN: GB82 WEST 1234 5698 7654 32.", "iban:6:33"),
        ("IBAN: GB82 WEST 1234 5698 7654 33.", ""),
        ("Kontonummer 12345678 und 12345678", "account:12:20"),
        ("GB82 WEST 1234 5698 7654 32", ""),
    ],
)
def test_added_kinds(text, spans):
    assert joined(pii.AnchorScanner().scan(text), pii.BASE_KINDS + pii.ADDED_KINDS) == spans


def test_whole_table(documents):
    rows = {r.doc_id: r for r in pii.find_personal_data(documents).collect()}
    for doc in documents.collect():
        wanted, row = brute.base_spans(doc.text), rows[doc.doc_id]
        assert row.base_sha256 == hashlib.sha256(wanted.encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [wanted.count(k + ":") for k in pii.BASE_KINDS]
    assert len(rows) == documents.count()


def test_masking(spark, awkward, no_documents, documents):
    rows = pii.mask_documents(documents).collect()
    assert [len(r.text) for r in rows] == [r.n_chars for r in rows]
    assert all(brute.base_spans(r.text) == "" for r in rows)
    assert pii.mask_documents(awkward).columns == awkward.columns
    assert sorted(map(str, pii.mask_documents(awkward).collect())) == sorted(map(str, awkward.collect()))
    assert len(pii.find_personal_data(awkward).collect()) == 16
    assert pii.mask_documents(no_documents).collect() == [] == pii.find_personal_data(no_documents).collect()
    one = spark.createDataFrame([(1, "to a@b.co, from +1 555 010 9999")], "doc_id long, text string")
    assert pii.mask_documents(one).first().text == "to <email>, from <phone>"


RULES = queries.URL_RULES


def judged(spark, urls, **settings_of):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    settings_of = url_templates.TreeSettings(**settings_of)
    return {r.page_id: r for r in url_templates.judge_urls(pages, RULES, settings_of).collect()}


def test_hosts_paths_and_rules(spark):
    urls = [
        None, "", "no scheme/x", "://", "http://EXAMPLE.org/es/1?x://y", "http://a.example.org/en/17#z", "http://org",
        "http://org/", "http://xorg/", "ftp://Ä.Com/de/", "http://com/fr", "http://u@com:80/fr/", "http://x.com/de/\n/y",
        "http://example.org/es/1?x://y", "x://y://com/fr/",
    ]
    for page_id, row in judged(spark, urls).items():
        host, path = brute.url_parts(urls[page_id])
        rule, verdict = brute.url_rule(host, path, RULES)
        assert (row.host, row.path, row.rule) == (host, path, rule)
        assert row.verdict == (verdict or row.verdict)
    assert judged(spark, []) == {}


def test_templates_follow_their_labels(spark):
    blocked = [f"http://a.com/de/{k}" for k in range(40)]
    allowed = [f"http://a.com/fr/{k}.html" for k in range(40)]
    unknown = [f"http://a.com/name{chr(97 + k)}x/{k}" for k in range(20)]
    rows = judged(spark, [*blocked, *allowed, *unknown, "http://b.net/x"])
    assert {rows[k].template for k in range(40)} == {"/de/#"} and rows[0].purity > 0.9
    assert {rows[k].template for k in range(40, 80)} == {"/fr/#.html"} and rows[40].purity < 0.1
    assert {rows[k].template for k in range(80, 100)} == {"/*/#"}
    assert rows[100].purity == pytest.approx(40.5 / 81)


def test_variable_segments_become_wildcards(spark):
    names = [chr(97 + a) + chr(97 + b) for a in range(6) for b in range(6)]
    rows = judged(spark, [f"http://h.net/user/{n}/about" for n in names] + ["http://h.net/user/"] * 3)
    assert {rows[k].template for k in range(36)} == {"/user/*/about"}


def test_deep_paths_are_generalised(spark):
    names = [chr(97 + a) + chr(97 + b) for a in range(6) for b in range(6)]
    urls = [f"http://h.net/x/1/b/c/d/e/{n}" for n in names] + [f"http://h.net/x/2/b/c/d/e/{n}q" for n in names[:10]]
    urls += [f"http://b.net/{n}" for n in names * 4] + ["http://d.net" + "/a" * 300]
    rules = (url_templates.Rule("block", "h.net", "/x/1"), url_templates.Rule("allow", "b.net", "/"))
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows = {r.page_id: r for r in url_templates.judge_urls(pages, rules).collect()}
    assert {rows[k].template for k in range(46)} == {"/x/#/b/c/d/e/*"}
    assert {rows[k].verdict for k in range(36, 46)} == {"block"} and len(rows) == len(urls)


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_queries_equal_their_sql(spark, name):
    assert differences(queries.LLM_QUERIES[name](spark, FOLDER), LLM_ORACLE[name], connect(FOLDER)) is None
