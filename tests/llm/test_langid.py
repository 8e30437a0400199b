import zlib

import zstandard
from pyspark.sql import functions as F

from sparkretail.llm import langid, tables
from sparkretail.llm.queries import QUERIES
from tests.llm.conftest import EDGE


def test_held_out_accuracy(spark, sf_small):
    docs = {r.doc_id: r for r in tables.documents(spark, "/root/testdata/sf0.01").collect()}
    got = QUERIES["op4_language_id"](spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) / len(held) > 0.93
    accepted = [r for r in held if r.accepted]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in accepted) / len(accepted) > 0.95


def test_edge_rows(spark, docs):
    model = langid.LanguageModel({"en": b"the of and to one two words", "de": "und der die das ist über".encode()})
    got = {r.doc_id: r for r in langid.predict(docs([*EDGE, (20, "12 $$ !!"), (21, "über die das")]), model).collect()}
    assert {k for k, r in got.items() if r.lang == "und"} == {1, 2, 3, 20}
    assert got[21].lang == "de" and got[1].score == 0 and not got[1].accepted
    assert langid.predict(docs([]), model).count() == 0
    empty = langid.fit(docs(EDGE))  # no row has a language
    assert empty.dictionaries == {} and langid.predict(docs([(1, "abc")]), empty).first().lang == "und"


def test_numerals_are_no_letters(spark, docs):
    model = langid.LanguageModel({"en": b"the of and", "de": b"und der die"})
    rows = [(1, "½ ²"), (2, "Ⅷ"), (3, "٣ १ _ 12"), (4, "Ⅷa"), (5, "日"), (6, "ª")]
    got = {r.doc_id: r.lang for r in langid.predict(docs(rows), model).collect()}
    assert {k for k, v in got.items() if v == "und"} == {1, 2, 3}


def test_sizes_against_plain_compression(spark, real):
    """Winner and margin from compressing every block anew."""
    model = langid.fit(real)
    ask = [(r.doc_id, r.text) for r in real.collect()]
    got = {r.doc_id: r for r in langid.predict(real, model).collect()}
    keep = {c for c in map(chr, range(33, 127)) if not c.isalpha()}
    for doc, text in ask[:60]:
        data = "".join(c for c in (text or "").lower() if c not in keep).encode()
        sizes = []
        for raw in model.dictionaries.values():
            d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            c = zstandard.ZstdCompressor(level=model.level, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)
            sizes.append(sum(len(c.compress(data[a:a + model.block])) for a in range(0, len(data), model.block)))
        best = min(range(len(sizes)), key=sizes.__getitem__)
        if got[doc].lang != "und":
            second = min(s for i, s in enumerate(sizes) if i != best)
            assert got[doc].lang == list(model.dictionaries)[best] and got[doc].margin == 1 - sizes[best] / second


def test_learns_only_from_admitted_rows(spark):
    rows = [(i, f"alpha beta gamma {i}", "xx" if i % 2 else "yy", "s", 1) for i in range(40)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    model = langid.fit(d, F.col("doc_id") % 2 == 1)
    assert list(model.dictionaries) == ["xx"]


def test_narrow_margins_are_rejected():
    c = langid.Classifier(langid.LanguageModel({"a": b"same words here", "b": b"same words here"}))
    lang, score, margin, ok = c.classify("same words")
    assert lang == "a" and margin == 0 and score == 0 and not ok
