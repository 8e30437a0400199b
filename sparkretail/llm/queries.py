"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from sparkretail.llm import alignment, ann, bpe, langid, licenses, mixing, packing, pii, quality, spelling, tables, toxicity
from sparkretail.llm.minhash import edit_fingerprints
from sparkretail.llm.ngram_join import ngram_jaccard_join
from sparkretail.llm.samples import fold_of


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(tables.documents(spark, sf_dir), k=3, threshold_pct=90)


def op2_minhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_fingerprints(tables.documents(spark, sf_dir), permutations=64)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(tables.documents(spark, sf_dir), capacity=2048)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.documents(spark, sf_dir)
    model = langid.fit(docs, fold_of(5) != 0)
    return langid.predict(docs, model).select(
        "doc_id", (fold_of(5) == 0).alias("held_out"), F.col("lang").alias("lang_pred"), "score", "margin", "accepted")


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the plan needs no text beyond its size
    return mixing.plan_copies(tables.documents(spark, sf_dir), keep=["doc_id"]).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def op6_kmeans_tree_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(tables.embeddings(spark, sf_dir), F.col("vec_id") % 20 == 0, k=20)


def op7_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_pii(tables.documents(spark, sf_dir).select("doc_id", "text"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(tables.documents(spark, sf_dir)).drop("expressions")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.documents(spark, sf_dir)
    model = toxicity.fit(docs, tables.labels(spark, sf_dir), fold_of(5) != 0)
    return toxicity.score(docs, model).select(
        "doc_id", (fold_of(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.documents(spark, sf_dir)
    model = quality.fit(docs, tables.labels(spark, sf_dir), fold_of(3) != 1)
    return quality.score(docs, *model).select(
        "doc_id", (fold_of(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.token_alignment(tables.documents(spark, sf_dir))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(tables.documents(spark, sf_dir))


def op13_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(tables.documents(spark, sf_dir)).select(
        "doc_id", F.floor(F.octet_length("ids") / 4).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_ngram_jaccard_join, op2_minhash_fingerprints, op3_best_fit_packing, op4_language_id,
    op5_source_mixing, op6_kmeans_tree_ann, op7_pii_surrogates, op8_license_scan, op9_toxicity, op10_quality,
    op11_token_alignment, op12_spelling_variants, op13_bpe_codec,
)}

OP1_SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws
  from documents),
s as (
  select doc_id, unnest(list_distinct(case when len(ws) = 0 then []
         when len(ws) < 3 then [array_to_string(ws, ' ')]
         else list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) end)) as g
  from w),
n as (select doc_id, count(*) as k from s group by doc_id),
p as (select a.doc_id as x, b.doc_id as y, count(*) as i from s a join s b on a.g = b.g and a.doc_id <> b.doc_id
      group by 1, 2),
l as (select x, y from p join n a on a.doc_id = x join n b on b.doc_id = y where 100 * i >= 90 * (a.k + b.k - i)),
r(doc_id, c) as (select doc_id, doc_id from documents union select l.y, r.c from r join l on l.x = r.doc_id)
select d.doc_id, cast(coalesce(n.k, 0) as bigint) as n_shingles, min(r.c) as component_id
from documents d join r using (doc_id) left join n using (doc_id) group by 1, 2
"""

#: crc32 byte by byte from its table of 256 remainders; near words through words with one letter left out
OP12_SQL = r"""
with recursive crc_table as (
  select list(list_reduce(range(8), lambda c, k: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end, i)
              order by i) as t from (select unnest(range(256))::bigint as i)),
run as (
  select doc_id, w, count(*) as n
  from (select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) as w from documents)
  where length(w) >= 6 group by all),
hashed as (
  select w, n, xor(list_reduce(list_transform(range(0, length(h) // 2), lambda i: ('0x' || h[2 * i + 1:2 * i + 2])::bigint),
                   lambda c, b: xor(t[xor(c, b) % 256 + 1], c // 256), 4294967295::bigint), 4294967295) as h
  from (select w, n, hex(doc_id::varchar || ':' || w) as h from run), crc_table),
word as (
  select word, sum(n)::bigint as n
  from (select case when h % 199 = 0 then left(w, (h % length(w))::int) || substr(w, (h % length(w))::int + 2) else w end as word, n
        from hashed)
  where length(word) >= 6 group by 1 having sum(n) >= 5),
without as (
  select word, n, i, left(word, i - 1) || substr(word, i + 1) as rest
  from (select word, n, unnest(range(1, length(word) + 1))::int as i from word)),
near as (
  select a.word, b.word as v, b.n as vn from without a join without b on a.rest = b.rest and a.i = b.i and a.word <> b.word
  union select a.word, b.word, b.n from without a join word b on a.rest = b.word
  union select b.word, a.word, a.n from without a join word b on a.rest = b.word),
best as (select word, count(*) as n_near, first(v order by vn desc, v) as v, max(vn) as vn from near group by 1),
formed as (
  select w.word, w.n, coalesce(n_near, 0) as n_near, case when vn >= 5 * w.n then v end as form,
         case when vn >= 5 * w.n then vn end as form_n
  from word w left join best b on w.word = b.word),
chain(word, last) as (
  select word, word from formed union all select c.word, f.form from chain c join formed f on c.last = f.word where f.form is not null)
select f.word, f.n, f.n_near, f.form, f.form_n, c.last as root
from formed f join chain c on c.word = f.word join formed l on l.word = c.last and l.form is null
"""

ORACLES: dict[str, str] = {"op1_ngram_jaccard_join": OP1_SQL, "op12_spelling_variants": OP12_SQL}
