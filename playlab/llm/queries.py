"""One query per operator, each over its whole table with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlab.llm import bpe, collocation, decontaminate, html_text, jaccard, language, neardup, packing
from playlab.llm import periodic, pii, secrets, substring, topk
from playlab.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return wrap


def tokenizer_file(name: str) -> str:
    """Path of a public vocabulary file: in $PLAYLAB_TOKENIZERS, or where the files are installed."""
    folder = os.environ.get("PLAYLAB_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def piece_digests(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "source")


@query("op1_packing")
def op1(spark, d):
    return piece_digests(packing.pack(table(spark, d, "documents"), tokenizer_file("word_bpe_49k.json")))


@query("op2_topk", """
with v as (select distinct vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
           from embeddings
           where vec_id is not null and embedding is not null and len(embedding) > 0
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id,
             cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) as bigint) as score
      from v q join v c on c.vec_id <> q.vec_id and len(c.v) = len(q.v) where q.vec_id % 50 = 0),
r as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from s)
select query_id, rank, vec_id, score from r where rank <= 5""")
def op2(spark, d):
    return topk.topk(table(spark, d, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op3_substring", r"""
with w as (select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as words
           from documents),
win as (select doc_id, i, list_slice(words, i, i + 19) as content
        from w, unnest(range(1, greatest(len(words) - 18, 1))) as u(i)),
ranked as (select doc_id, i, row_number() over (partition by content order by doc_id, i) as nth from win),
gone as (select distinct doc_id, i + k as place from ranked, unnest(range(0, 20)) as u(k) where nth > 1),
kept as (select w.doc_id, count(g.place) as n_removed,
                string_agg(w.words[p.i], ' ' order by p.i) filter (where g.place is null) as kept
         from w, unnest(range(1, len(words) + 1)) as p(i)
         left join gone g on g.doc_id = w.doc_id and g.place = p.i group by w.doc_id)
select w.doc_id, len(w.words) as n_words, coalesce(k.n_removed, 0) as n_removed, sha256(coalesce(k.kept, '')) as kept_sha256
from w left join kept k on k.doc_id = w.doc_id""")
def op3(spark, d):
    return (substring.deduplicate(table(spark, d, "documents").select("doc_id", "text"))
            .select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")))


@query("op4_pii")
def op4(spark, d):
    found = pii.scan(table(spark, d, "documents").select("doc_id", "text"))
    count = lambda k: F.size(F.filter("pii", lambda s: s.kind == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[count(k) for k in pii.BASE_KINDS],
                        F.sha2(pii.span_list("pii", pii.BASE_KINDS), 256).alias("base_sha256"),
                        pii.span_list("pii").alias("spans"))


@query("op5_neardup")
def op5(spark, d):
    return neardup.near_duplicates(table(spark, d, "embeddings")).select("vec_id", "n_links", "component_id", "kept")


@query("op6_secrets")
def op6(spark, d):
    docs = table(spark, d, "documents")
    found = secrets.scan(docs.select("doc_id", "text", "source"), secrets.train(docs))
    return found.select("doc_id", F.explode("secrets").alias("s")).select("doc_id", "s.nth", "s.secret", "s.score")


@query("op7_language")
def op7(spark, d):
    docs = table(spark, d, "documents")
    model = language.train(docs.where(~language.held_out()))
    return (language.identify(docs.select("doc_id", "text"), model)
            .select("doc_id", language.held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score")))


@query("op8_jaccard")
def op8(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    return jaccard.jaccard_groups(docs).select("doc_id", "n_shingles", "component_id")


@query("op9_html")
def op9(spark, d):
    pages = table(spark, d, "pages").select("page_id", "url", "html")
    found = html_text.extract(pages, html_text.train(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op10_bpe")
def op10(spark, d):
    path = tokenizer_file("byte_bpe_50k.json")
    coded = bpe.decode(bpe.encode(table(spark, d, "documents"), path), path)
    return coded.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """The texts that op11 looks at: of every tenth document, by a hash of its id, the words from one place on
    repeat with a period (both follow from the hash)."""
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    n, a = F.col("n"), F.col("a")
    period = F.col("period")
    tail = F.flatten(F.array_repeat(F.slice("words", a + 1, period), F.ceil((n - a) / period).cast("int")))
    return (docs.withColumn("words", F.when(h % 10 == 0, words)).withColumn("n", F.size("words"))
            .withColumn("a", F.when(n > 0, g % n).cast("int"))
            .withColumn("period", F.when(n > 0, 1 + F.floor((n - a) / (3 + g % 8))).cast("int"))
            .select("doc_id", F.when((h % 10 == 0) & (n > 0), F.array_join(
                F.concat(F.slice("words", 1, a), F.slice(tail, 1, n - a)), " ")).otherwise(F.col("text")).alias("text")))


@query("op11_periodic", r"""
with words as (select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as words,
                      list_transform(string_split(cast(doc_id as varchar), ''), lambda c: cast(ascii(c) as bigint)) as bytes
               from documents),
hashed as (select *, xor(list_reduce(bytes, lambda crc, byte: list_reduce([0, 0, 0, 0, 0, 0, 0, 0], lambda x, _: case
                         when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end, xor(crc, byte)), 4294967295), 4294967295) as h
           from words),
places as (select *, h // 10 as g, case when len(words) > 0 and h % 10 = 0 then (h // 10) % len(words) end as a from hashed),
lengths as (select *, 1 + (len(words) - a) // (3 + g % 8) as p from places),
docs as (select doc_id, case when a is null then words else list_transform(range(0, len(words)), lambda i: case
                when i < a then words[i + 1] else words[a + (i - a) % p + 1] end) end as words from lengths),
grams as (select doc_id, i, list_slice(words, i + 1, i + 6) as gram from docs, unnest(range(0, greatest(len(words) - 5, 0))) as u(i)),
pairs as (select x.doc_id, x.i, y.i - x.i as d from grams x join grams y on x.doc_id = y.doc_id and x.gram = y.gram and y.i > x.i),
islands as (select doc_id, d, i, i - row_number() over (partition by doc_id, d order by i) as island from pairs),
stretches as (select doc_id, d, min(i) as start, count(*) + 5 + d as length from islands group by doc_id, d, island
              having count(*) + 5 >= d and count(*) + 5 + d >= 12),
runs as (select doc_id, start, length, min(d) as period from stretches group by doc_id, start, length),
ranked as (select *, row_number() over (partition by doc_id order by length desc, start, period) as nth from runs),
listed as (select doc_id, count(*) as n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as l
           from runs group by doc_id),
gone as (select distinct doc_id, i from runs, unnest(range(start + period, start + length)) as u(i)),
kept as (select docs.doc_id, string_agg(words[u.i + 1], ' ' order by u.i) as kept from docs, unnest(range(0, len(words))) as u(i)
         left join gone on gone.doc_id = docs.doc_id and gone.i = u.i where gone.i is null group by docs.doc_id)
select docs.doc_id, coalesce(n_runs, 0) as n_runs, start, length, period, 1000 * length // period as exponent_milli,
       sha256(coalesce(l, '')) as runs_sha256, sha256(coalesce(kept, '')) as collapsed_sha256
from docs left join listed using (doc_id) left join ranked on ranked.doc_id = docs.doc_id and nth = 1
left join kept on kept.doc_id = docs.doc_id""")
def op11(spark, d):
    docs = with_periodic_tails(table(spark, d, "documents").select("doc_id", "text"))
    found = periodic.periodic_runs(docs)
    order = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("s"),
                                                               (-r.period).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return (found.withColumn("longest", order)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.s")).alias("start"),
                    F.col("longest.length").alias("length"), (-F.col("longest.p")).alias("period"),
                    F.floor(1000 * F.col("longest.length") / -F.col("longest.p")).alias("exponent_milli"),
                    F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
                    F.sha2("collapsed", 256).alias("collapsed_sha256")))


@query("op12_decontaminate", r"""
with w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from documents),
b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from benchmark),
win as (select distinct coalesce(cast(item_id as varchar), '') as item, least(10, len(words)) as k,
               array_to_string(list_slice(words, i, i + least(10, len(words)) - 1), ' ') as content
        from b, unnest(range(1, len(words) - least(10, len(words)) + 2)) as u(i) where len(words) > 0),
places as (select doc_id, i, k, array_to_string(list_slice(words, i, i + k - 1), ' ') as content
           from w, (select distinct k from win), unnest(range(1, greatest(len(words) - k + 2, 1))) as u(i)),
found as (select doc_id, i, k, item from places join win using (k, content)),
hit as (select doc_id, count(distinct i + j) as n_hit from (select distinct doc_id, i, k from found), unnest(range(0, k)) as u(j)
        group by doc_id),
items as (select doc_id, count(*) as n_items, sha256(string_agg(item, ',' order by item)) as items_sha256
          from (select distinct doc_id, item from found) group by doc_id)
select w.doc_id, len(w.words) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       coalesce(items_sha256, sha256('')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from w left join hit using (doc_id) left join items using (doc_id)""")
def op12(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    found = decontaminate.decontaminate(docs, table(spark, d, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@query("op13_collocation", r"""
with pieces as (select coalesce(lang, 'und') as lang, doc_id, unnest(regexp_split_to_array(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
                from documents),
cut as (select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') as w from pieces),
numbered as (select lang, row_number() over () as piece, w from cut),
words as (select lang, piece, unnest(w) as w1, unnest(range(1, len(w) + 1)) as i from numbered),
following as (select lang, w1, lead(w1, 1) over p as w2, lead(w1, 2) over p as w3, lead(w1, 3) over p as w4, lead(w1, 4) over p as w5
              from words window p as (partition by piece order by i)),
grams as (select lang, 1 as s, w1 as phrase from following
          union all select lang, 2, w1 || ' ' || w2 from following where w2 is not null
          union all select lang, 3, w1 || ' ' || w2 || ' ' || w3 from following where w3 is not null
          union all select lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 from following where w4 is not null
          union all select lang, 5, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 || ' ' || w5 from following where w5 is not null),
totals as (select lang, count(*) as n from grams where s = 1 group by lang),
f as (select lang, phrase, s, count(*) as f from grams group by all),
candidates as (select lang, phrase, s, f as a, string_split(phrase, ' ') as w from f where s > 1 and f >= 100),
cuts as (select c.lang, phrase, s, a, k, lang || ':' || array_to_string(list_slice(w, 1, k), ' ') as lp,
                lang || ':' || array_to_string(list_slice(w, k + 1, s), ' ') as rp
         from candidates c, unnest(range(1, s)) as u(k)),
scored as (select c.lang, c.phrase, c.s, c.a, k, fl.f as l, fr.f as r, t.n,
                  cast(1000 * cast(a as hugeint) * n // (cast(fl.f as hugeint) * fr.f) as bigint) as score
           from cuts c join f fl on fl.lang || ':' || fl.phrase = c.lp join f fr on fr.lang || ':' || fr.phrase = c.rp
           join totals t on t.lang = c.lang),
best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
kept as (select * from best b where not exists (select 1 from candidates c where c.lang = b.lang and c.s > b.s
             and contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' ') and 100 * c.a >= 100 * b.a))
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from kept qualify rank <= 2000""")
def op13(spark, d):
    return collocation.collocations(table(spark, d, "documents").select("lang", "text"))
