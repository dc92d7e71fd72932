"""Phrase collocation mining by multikey quicksort of suffix pointers (operator 13).

Texts, lower-cased in A-Z, are cut at ``.,;:!?`` and line ends into pieces, pieces at spaces and
tabs into words.  Everything is counted per language: n words, and f(phrase) for the
phrases inside pieces.  A candidate has 2 to ``max_words`` words and f >= ``least``.

1. First pass: words and word pairs are counted by 64-bit hashes, combined in each slice of text and
   summed per hash bucket.  Those with a sum of at least ``least`` set a bit in a
   filter of fixed size (8 MB), which is broadcast.  A set bit may be wrong, a clear one cannot, so
   the filter only saves work: a phrase with a clear pair is no candidate.
2. Second pass: the suffixes of pieces, to the depth of ``max_words`` words and as far as their pairs
   pass the filter, are combined in each slice and routed globally by language and the hash of their two leading words.
   Single words are counted exactly in the same pass.
3. In each route, a three-way multikey quicksort partitions the suffix pointers by their first word,
   the equal part by the next one, and so on.  The size of an equal part is its
   phrase's count; parts smaller than ``least`` are abandoned, since nothing in them can be frequent.
4. Scores of all cuts, by joins of the counted phrases, in exact decimals.

A route is sized for ``ROUTE_BYTES`` of text.  One that holds more than ``most`` suffixes (a hot pair)
is dealt by its third word as well, then by its fourth and fifth; counts of the prefixes
that such a route does not hold whole are partial, and summed by a last aggregate.  So no
task holds more than about ``most`` different suffixes, and copies count once per slice.

Results: null text has no pieces; null language is ``und``; repeated documents count each time;
an empty table gives no rows; ties go as the order states; further columns play no part.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from playlab.llm.common import Numbering, mix64
from playlab.session import ship_package, write_stage

SLICE = 8 << 20  # bytes of text combined before they are shuffled
ROUTE_BYTES = 32 << 20
MOST = 4_000_000
FILTER_BITS = 26  # the filter has 2**26 bits

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_CUT = bytes(b + 32 if 65 <= b <= 90 else 10 if chr(b) in ".,;:!?\n\x0b\x0c\r" else b for b in range(256))
_BREAK = b"\xff"  # a token between pieces; no word has this byte
_BITMAP = 32768  # bits of one row of Spark's bitmap functions


def _lang_slices(batches):
    """(language, data) of consecutive texts, about ``SLICE`` bytes each."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            raw = text.encode()
            held.setdefault(lang, []).append(raw)
            size += len(raw)
            if size >= SLICE:
                yield from ((k, b"\n".join(v)) for k, v in held.items())
                held, size = {}, 0
    yield from ((k, b"\n".join(v)) for k, v in held.items())


def tokens(data: bytes):
    """Numbers of the words in order, 0 between pieces and at the end, and the words by number."""
    number = Numbering({_BREAK: 0})
    words = data.translate(_CUT).replace(b"\n", b" " + _BREAK + b" ").split()
    ids = np.zeros(len(words) + 1, np.int64)
    ids[:-1] = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    return ids, list(number)


def _word_hashes(words: list[bytes], lang: str) -> np.ndarray:
    h = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    return mix64(h + (np.uint64(zlib.crc32(lang.encode())) << np.uint64(32)))


def _pair_hashes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix64(a * _MULTIPLIER + b)


def _passes(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    place = h >> np.uint64(64 - FILTER_BITS)
    return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def frequent_filter(texts: DataFrame, least: int, buckets: int) -> np.ndarray:
    """The filter: a bit for every hash of a word or pair whose occurrences may reach ``least``."""
    def count(batches):
        for lang, data in _lang_slices(batches):
            ids, words = tokens(data)
            h = _word_hashes(words, lang)
            a, b = ids[:-1], ids[1:]
            inside = (a > 0) & (b > 0)
            pair, n = np.unique(a[inside] * len(words) + b[inside], return_counts=True)
            h = np.r_[mix64(h[1:]), _pair_hashes(h[pair // len(words)], h[pair % len(words)])]
            n = np.r_[np.bincount(ids, minlength=len(words))[1:], n]
            bucket = h % np.uint64(buckets)
            order = np.lexsort((h, n > 1, bucket))
            h, n, bucket = h[order], n[order].astype(np.uint32), bucket[order].astype(np.int32)
            cuts = np.r_[0, np.flatnonzero(np.diff(bucket)) + 1, len(h)]
            spans = [(i, j) for i, j in zip(cuts[:-1], cuts[1:]) if j > i]
            once = [i + int(np.searchsorted(n[i:j], 2)) if n[i] == 1 else i for i, j in spans]
            # occurrences of once-only hashes are not written
            yield pa.RecordBatch.from_arrays(
                [pa.array([bucket[i] for i, _ in spans], pa.int32()), pa.array([h[i:j].tobytes() for i, j in spans], pa.binary()),
                 pa.array([n[k:j].tobytes() for k, (_, j) in zip(once, spans)], pa.binary())], names=["bucket", "h", "n"])

    def total(group: pa.Table) -> pa.Table:
        h, n = [], []
        for raw, more in zip(group.column("h").to_pylist(), group.column("n").to_pylist()):
            h.append(np.frombuffer(raw, np.uint64))
            more = np.frombuffer(more, np.uint32)
            n.append(np.r_[np.ones(len(h[-1]) - len(more), np.int64), more])
        h, n = np.concatenate(h), np.concatenate(n)
        order = np.argsort(h)
        h, n = h[order], n[order]
        first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        often = h[first[np.add.reduceat(n, first) >= least]]
        return pa.table({"place": pa.array(np.unique(often >> np.uint64(64 - FILTER_BITS)).astype(np.int64) + 1)})

    places = (texts.mapInArrow(count, "bucket int, h binary, n binary")
              .groupBy("bucket").applyInArrow(total, "place long"))
    rows = (places.groupBy(F.bitmap_bucket_number("place").alias("row"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")).collect())
    bits = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for r in rows:
        at = (r.row - 1) * (_BITMAP // 8)
        bits[at:at + _BITMAP // 8] = np.frombuffer(r.bits, np.uint8)
    return bits


def _blob(columns: list[np.ndarray], weight: np.ndarray, words: list[bytes]):
    """(number of suffixes, its words, suffixes by columns, weights); in a suffix 0 means no word."""
    used = np.unique(np.concatenate(columns))
    used = used[used > 0]
    lookup = np.r_[0, used]
    places = np.concatenate([np.searchsorted(lookup, c) for c in columns]).astype(np.uint32)
    return len(weight), b" ".join([words[i] for i in used.tolist()]), places.tobytes(), weight.astype(np.int64).tobytes()


def _unblob(vocabulary: bytes, places: bytes, weight: bytes):
    w = np.frombuffer(weight, np.int64)
    return [_BREAK, *vocabulary.split(b" ")], np.frombuffer(places, np.uint32).reshape(-1, len(w)).astype(np.int64), w


def _combined(keys: list[np.ndarray], weight: np.ndarray):
    """Distinct rows of some columns, sorted by the first, the second ...; weights summed."""
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    first = np.flatnonzero(new)
    return [k[first] for k in keys], np.add.reduceat(weight[order], first) if len(first) else weight[:0]


def _dealt(route: np.ndarray, columns, weight, words):
    """One blob per route; the rows are in the order of their routes."""
    cuts = np.r_[0, np.flatnonzero(np.diff(route)) + 1, len(route)]
    for i, j in zip(cuts[:-1], cuts[1:]):
        if j > i:
            yield int(route[i]), *_blob([c[i:j] for c in columns], weight[i:j], words)


_ROUTED = "lang string, route long, sub long, n long, words binary, places binary, weight binary"
_WORDS = -1  # the route of a slice's word counts


def suffixes(texts: DataFrame, bits, routes: int, max_words: int) -> DataFrame:
    """Routed suffixes with their weights, and the word counts of every slice (``n``: all its words)."""
    def cut(batches):
        for lang, data in _lang_slices(batches):
            ids, words = tokens(data)
            h = _word_hashes(words, lang)
            often = _passes(bits.value, mix64(h))
            often[0] = False
            count = np.bincount(ids, minlength=len(words))
            known = np.flatnonzero(often)
            rows = [(lang, _WORDS, 0, int(count[1:].sum()), b" ".join([words[i] for i in known.tolist()]), b"",
                     count[known].astype(np.int64).tobytes())]
            a, b = ids[:-1], ids[1:]
            at = np.flatnonzero(often[a] & often[b])
            at = at[_passes(bits.value, _pair_hashes(h[a[at]], h[b[at]]))]
            linked = np.zeros(len(ids) + max_words, bool)
            linked[at] = True
            ids = np.r_[ids, np.zeros(max_words, np.int64)]
            columns, going = [ids[at], ids[at + 1]], np.ones(len(at), bool)
            for k in range(2, max_words):
                going = going & linked[at + k - 1]
                columns.append(np.where(going, ids[at + k], 0))
            route = (_pair_hashes(h[columns[0]], h[columns[1]]) % np.uint64(routes)).astype(np.int64)
            keys, weight = _combined([route, *columns], np.ones(len(at), np.int64))
            rows += [(lang, r, 0, *rest) for r, *rest in _dealt(keys[0], keys[1:], weight, words)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), [pa.string()] + [pa.int64()] * 3 + [pa.binary()] * 3)],
                names=["lang", "route", "sub", "n", "words", "places", "weight"])

    return texts.mapInArrow(cut, _ROUTED)


def _split_hot(routed: DataFrame, most: int, max_words: int) -> DataFrame:
    """``routed`` with the number of leading words that it is routed by (``depth``); routes that hold more than ``most``
    suffixes are dealt by one more word, and again."""
    routed = routed.withColumn("depth", F.lit(2))
    for depth in range(3, max_words + 1):
        hot = (routed.where((F.col("route") != _WORDS) & (F.col("depth") == depth - 1)).groupBy("lang", "route", "sub").agg(F.sum("n").alias("load"))
               .where(F.col("load") > most).withColumn("parts", F.ceil(2 * F.col("load") / most)).drop("load"))
        if not hot.limit(1).count():
            break

        def deal(batches, depth=depth):
            for batch in batches:
                rows = []
                for r in batch.to_pylist():
                    words, columns, weight = _unblob(r["words"], r["places"], r["weight"])
                    h = _word_hashes(words, r["lang"])
                    # the sub-route before enters too, so its parts stay apart
                    part = _pair_hashes(h[columns[depth - 1]], np.uint64(r["sub"])) % np.uint64(r["parts"])
                    sub = (mix64(part + np.uint64(r["sub"])) >> np.uint64(2)).astype(np.int64)
                    order = np.argsort(sub, kind="stable")
                    rows += [(r["lang"], r["route"], s, *rest, depth)
                             for s, *rest in _dealt(sub[order], [c[order] for c in columns], weight[order], words)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 8,
                                                    [pa.string()] + [pa.int64()] * 3 + [pa.binary()] * 3 + [pa.int32()])],
                    names=["lang", "route", "sub", "n", "words", "places", "weight", "depth"])

        keys = ["lang", "route", "sub"]
        dealt = routed.where(F.col("depth") == depth - 1).join(hot, keys).mapInArrow(deal, _ROUTED + ", depth int")
        routed = write_stage(routed.join(hot.select(*keys, F.lit(True).alias("hot")), keys, "left")
                             .where("hot is null or depth <> %d" % (depth - 1)).drop("hot")
                             .select(*dealt.columns).unionByName(dealt), "collocation-dealt")
    return routed


def frequent_prefixes(columns: np.ndarray, weight: np.ndarray, least: int, shortest: int):
    """(suffix, words, weight) of every prefix of at least ``shortest`` words whose suffixes weigh ``least`` or more.

    Multikey quicksort: pointers are split three ways by one word, the equal part goes on
    with the next word, and parts below ``least`` are left as they are.
    """
    parts = [(np.arange(len(weight)), 0)]
    while parts:
        at, depth = parts.pop()
        if len(at) == 0 or weight[at].sum() < least:
            continue
        key = columns[depth][at]
        sample = np.sort(key[::max(1, len(key) // 32)])
        pivot = sample[len(sample) // 2]
        less, equal = key < pivot, key == pivot
        parts.append((at[less], depth))
        parts.append((at[~(less | equal)], depth))
        same = at[equal]
        if pivot > 0:
            total = int(weight[same].sum())
            if total >= least:
                if depth + 1 >= shortest:
                    yield int(same[0]), depth + 1, total
                if depth + 1 < len(columns):
                    parts.append((same, depth + 1))


def phrase_counts(routed: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, n) of the phrases of two words or more with n >= least."""
    def count(key, group):
        lang, depth = key[0].as_py(), key[3].as_py()
        number, columns, weight = Numbering({_BREAK: 0}), [], []
        for vocabulary, places, w in zip(*(group.column(c).to_pylist() for c in ("words", "places", "weight"))):
            words, places, w = _unblob(vocabulary, places, w)
            columns.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words))[places])
            weight.append(w)
        columns, weight = np.concatenate(columns, axis=1), np.concatenate(weight)
        words = list(number)
        phrases, counts = [], []
        for k in range(2, depth):  # prefixes that other routes may hold too: partial counts
            has = columns[k - 1] > 0
            keys, sums = _combined([c[has] for c in columns[:k]], weight[has])
            phrases += [b" ".join([words[i] for i in row]) for row in zip(*(c.tolist() for c in keys))]
            counts += sums.tolist()
        for at, size, total in frequent_prefixes(columns, weight, least, depth):
            phrases.append(b" ".join([words[i] for i in columns[:size, at].tolist()]))
            counts.append(total)
        return pa.table({"lang": pa.array([lang] * len(counts), pa.string()),
                         "phrase": pa.array([p.decode() for p in phrases], pa.string()), "n": pa.array(counts, pa.int64())})

    return (routed.where(F.col("route") != _WORDS).groupBy("lang", "route", "sub", "depth")
            .applyInArrow(count, "lang string, phrase string, n long")
            .groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least))


def word_counts(routed: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, n) of the single words with n >= least."""
    def unpack(batches):
        for batch in batches:
            for lang, words, weight in zip(*(batch.column(i).to_pylist() for i in range(3))):
                words = words.decode().split(" ") if words else []
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words), pa.string()), pa.array(words, pa.string()),
                                                  pa.array(np.frombuffer(weight, np.int64))], names=["lang", "phrase", "n"])

    return (routed.where(F.col("route") == _WORDS).select("lang", "words", "weight")
            .mapInArrow(unpack, "lang string, phrase string, n long")
            .groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least))


def phrases(docs: DataFrame, max_words: int = 5, least: int = 100, most: int = MOST, text: str = "text", lang: str = "lang"):
    """(all counted phrases: lang, phrase, size, n; words per language: lang, n)."""
    spark = docs.sparkSession
    ship_package(spark)
    texts = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
                        F.col(f"`{text}`").alias("text")).where("text is not null")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    routes = max(1, -(-size // ROUTE_BYTES))
    bits = spark.sparkContext.broadcast(frequent_filter(texts, least, routes))
    routed = write_stage(suffixes(texts, bits, routes, max_words), "collocation-suffixes")
    found = word_counts(routed, least).unionByName(phrase_counts(_split_hot(routed, most, max_words), least))
    counts = write_stage(found.withColumn("size", F.size(F.split("phrase", " "))), "collocation-counts")
    return counts, routed.where(F.col("route") == _WORDS).groupBy("lang").agg(F.sum("n").alias("n"))


def collocations(docs: DataFrame, max_words: int = 5, least: int = 100, share: int = 100, top: int | None = 2000,
                 most: int = MOST, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases (None: all).

    a = f(phrase); the cut with the smallest floor(1000 a n / (l r)) counts, at ties the first.  Candidates inside a
    longer one with 100 f(longer) >= share a go; it is enough to look at those one word longer, as
    every phrase between the two is a candidate that is at least as frequent.
    """
    counts, totals = phrases(docs, max_words, least, most, text, lang)
    big = lambda c: F.col(c).cast("decimal(20,0)")
    candidates = counts.where("size > 1").select("lang", "phrase", F.col("n").alias("a"), "size",
                                                 F.split("phrase", " ").alias("w"))
    part = lambda start, length: F.array_join(F.slice("w", start, length), " ")
    cuts = (candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
            .select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"),
                    part(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
            .join(counts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
            .join(counts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
            .join(totals, "lang").withColumn("product", big("a") * big("n") * F.lit(1000).cast("decimal(5,0)"))
            .withColumn("ways", big("l") * big("r")).withColumn("score", F.expr("product div ways")))
    scored = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("s"))
    inside = (candidates.where("size > 2")
              .select("lang", F.col("a").alias("longer"), F.explode(F.array_distinct(F.array(
                  part(F.lit(1), F.col("size") - 1), part(F.lit(2), F.col("size") - 1)))).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    left = (scored.join(inside, ["lang", "phrase"], "left").where(F.expr(
        f"longer is null or cast(100 as decimal(5,0)) * longer < cast({int(share)} as decimal(20,0)) * s.a")))
    order = Window.partitionBy("lang").orderBy(F.desc("s.score"), F.desc("s.a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(order))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "s.a", "s.l", "s.r", "s.n", "s.score")
