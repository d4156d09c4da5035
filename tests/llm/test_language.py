import random

from edgewise.llm import language as L

SYLLABLES = {"aa": ["ba", "ko", "mi"], "bb": ["ba", "ro", "ti"], "cc": ["zu", "we", "xo"]}


def prose(rng, lang, words):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(2, 5))) for _ in range(words))


def page(text, lang=None):
    return f"<html{f' lang={chr(34)}{lang}{chr(34)}' if lang else ''}><style>p{{zuwe:0}}</style><body><!-- zuwexo --><p>{text}</p></body></html>"


def made(rng):
    docs = [(i, prose(rng, lang, 80), lang) for i in range(60) for lang in [sorted(SYLLABLES)[i % 3]]]
    pages = [(i, f"http://h{i % 5}.{lang}site.org/x", page(prose(rng, lang, 40), lang)) for i in range(90) for lang in [sorted(SYLLABLES)[i % 3]]]
    return docs, pages


def run(spark, pages, docs, **more):
    p = spark.createDataFrame([(*r, 0) for r in pages], "page_id bigint, url string, html string, lang int")
    d = spark.createDataFrame(docs, "doc_id bigint, text string, lang string")
    return {r.page_id: r for r in L.identify(p, d, **more).collect()}


def test_held_out_accuracy_and_both_ways_agree(spark):
    docs, pages = made(random.Random(1))
    got = run(spark, pages, docs)
    assert all(r.lang == r.text_lang == r.url.split(".")[1][:2] for r in got.values()) and len(got) == 90
    joined = run(spark, pages, docs, broadcast_grams=0)
    assert all(joined[i].lang == r.lang and abs(joined[i].probability - r.probability) < 1e-9 for i, r in got.items())


def test_other_evidence_decides_where_the_text_is_silent(spark):
    rng = random.Random(2)
    docs, pages = made(rng)
    pages += [(1000, "http://h1.ccsite.org/q", page("12345")), (1001, "http://other.net/q", page("", "bb")),
              (1002, "http://h1.aasite.org/", page(prose(rng, "cc", 200), "aa")), (1003, None, None), (1004, "not a url", "")]
    got = run(spark, pages, docs)
    assert got[1000].lang == "cc" and got[1000].text_lang is None
    assert got[1001].lang == "bb" and got[1002].lang == "cc"
    assert got[1003].lang in SYLLABLES and got[1003].host == "" and got[1004].lang in SYLLABLES


def test_host_counts_leave_the_page_itself_out(spark):
    docs, pages = made(random.Random(3))
    lone = [(2000, "http://lone.zz/x", page("ba ba", None))]
    alone = run(spark, pages + lone, docs)[2000]
    assert 0.3 < alone.probability < 0.95


def test_empty_tables_and_repeated_rows(spark):
    docs, pages = made(random.Random(4))
    assert run(spark, [], docs) == {}
    none = run(spark, pages[:3], [(1, None, "aa"), (2, "ba", None)])
    assert len(none) == 3 and all(r.lang is None for r in none.values())
    p = spark.createDataFrame(pages[:1] * 3, "page_id bigint, url string, html string")
    d = spark.createDataFrame(docs, "doc_id bigint, text string, lang string")
    assert L.identify(p, d).count() == L.identify(p, d, broadcast_grams=0).count() == 3
