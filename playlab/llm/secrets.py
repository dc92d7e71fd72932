"""Secret scan with a random forest against false positives (operator 6, SQL functions only).

Candidates are the maximal runs of at least ``MIN_LENGTH`` token characters, cut at
the ``=`` between a name and a value and at the borders of a provider's fixed format inside
the run, and values of ``SHORT`` or more characters directly after a credential's name.
Each text is split at their borders, so a candidate stands between the texts before and
after it; a name just before the assignment counts as text before.  A forest judges every candidate by its length, its changes between character
classes, how much of it dictionary words cover, the document's path, and the
neighbouring words.

The forest is fitted by Spark ML on labelled findings.  ``labelled`` makes them of a
bounded sample of documents (those with the smallest key hash, about
``SAMPLE_DOCUMENTS``), so their truth is known and does not come from the features:
excerpts of the documents get ``PER_DOCUMENT`` planted values.  Half are secrets (hexadecimal and dense
values, short and worded passwords after a credential's name, bearer tokens, lines of a private key), half
are not (checksums and commits, UUIDs, joined words, paths, numbers, plain words and placeholders after a
credential's name).  To these come the documents' own candidates that are plain words, placeholders or
in a provider's fixed format.  The words of the dictionary are counted over all documents: those of 4 to 12
letters that make up at least one in ``DICTIONARY_SHARE`` of all such words, hence at most that many.
The fitted trees become one SQL expression over the arrays of a row, so a scan of
the corpus is one pass without a shuffle, Python code or exploded rows; the score
of a candidate is the share of trees that call it a secret, and 1 for a provider's
fixed format, the parts of a JSON web token, the password of a URI, and a shorter value of letters and
digits that is no placeholder, which the sample need not hold.

Edge cases: null or empty text has no candidates and stays as it is; runs of any
length are judged whole; repeated rows are judged alike; further columns are kept, but for any
named ``secrets`` or ``clean``, which the results replace; a null key is a key like others; findings of one kind only
(given by the caller) make a forest that always votes so, none at all one that finds only
the fixed formats; ties of the vote (score = threshold) count as secrets.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlab.session import write_stage

MIN_LENGTH = 16
SAMPLE_DOCUMENTS = 20_000
PER_DOCUMENT = 4  # planted values of a sampled document
DICTIONARY_SHARE = 4000
TREES = 20
DEPTH = 5
THRESHOLD = 0.5
MASK = "[SECRET]"
NEAR = 48  # characters of the neighbouring texts that are looked at

_CHARS = "A-Za-z0-9_+/=-"
_BORDER = f"(?<![{_CHARS}])(?=[{_CHARS}]{{{MIN_LENGTH}}})|(?![{_CHARS}])(?<=[{_CHARS}]{{{MIN_LENGTH}}})"
_IS_CANDIDATE = f"^[{_CHARS}]{{{MIN_LENGTH},}}$"
_CUT = "\n"  # stands in no run, so it can mark places to cut inside one
# Formats and names by which providers' credentials are known.
_FORMATS = ("^(AKIA|ASIA)[A-Z0-9]{16}$|^gh[pousr]_[A-Za-z0-9]{36}$|^xox[baprs]-[A-Za-z0-9-]{20,}$"
            "|^sk_(live|test)_[A-Za-z0-9]{20,}$|^AIza[A-Za-z0-9_-]{35}$|^glpat-[A-Za-z0-9_-]{20}$")
# The same formats inside a run: where no further letter or digit is beside them.
_FORMAT_INSIDE = ("(?<![A-Za-z0-9])((?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])|gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])"
                  "|xox[baprs]-[A-Za-z0-9-]{20,}|sk_(?:live|test)_[A-Za-z0-9]{20,}"
                  "|AIza[A-Za-z0-9_-]{35}(?![A-Za-z0-9_-])|glpat-[A-Za-z0-9_-]{20}(?![A-Za-z0-9_-]))")
_NAMES = "(?i)(token|secret|passw|pwd|api.?key|access.?key|auth|bearer|credential|private.?key)"
_ASSIGNED = "[=:]\\s*[\"'`]?$"
_ASSIGNS = "^[\"'`]?\\s*[=:]"
# Directly after a credential's name and an assignment, shorter values are candidates too.
SHORT = 8
_DIRECT = ("(?i:token|secret|password|passwd|pwd|api.?key|access.?key|secret.?key|auth|credential|private.?key)"
           "[\"'`]?\\s{0,2}[=:]\\s{0,2}[\"'`]?")
_VALUE = "[A-Za-z0-9_+/-]"
_SHORT_BORDER = (f"(?<=[=:\"'`\\s])(?={_VALUE}{{{SHORT},{MIN_LENGTH - 1}}}(?!{_VALUE}))(?<={_DIRECT})"
                 f"|(?!{_VALUE})(?<={_VALUE}{{{SHORT}}})(?<={_DIRECT}{_VALUE}{{{SHORT},{MIN_LENGTH - 1}}})")
_MIXED = "^(?=(?:.*[0-9]){3})(?=(?:.*[A-Za-z]){3})[A-Za-z0-9_+/=-]+$"
_IS_SHORT = f"^{_VALUE}{{{SHORT},{MIN_LENGTH - 1}}}$"
# The parts of a JSON web token, and the password of a URI.
_JWT = "^eyJ[A-Za-z0-9_-]{10,}$"
_AFTER_JWT = "eyJ[A-Za-z0-9_-]{10,}[.]$"
_USER = "://[A-Za-z0-9_.%-]{1,48}:"
_URI_PASSWORD = "[^\\s@/:]{3,100}"
_URI_BORDER = f"(?<=:)(?={_URI_PASSWORD}@)(?<={_USER})|(?=@)(?<=[^\\s@/:]{{3}})(?<={_USER}{_URI_PASSWORD})"
_PLACEHOLDER = "(?i)example|sample|dummy|placeholder|changeme|xxxx|0000000|1234567|abcdef"
_TEST_PATH = "(?i)test|example|sample|fixture|mock|doc"

FEATURES = ("length", "digits", "uppers", "lowers", "symbols", "changes", "distinct", "longest_letters", "hex",
            "covered", "named", "assigned", "quoted", "starts_line", "plain_before", "plain_after", "path_test",
            "path_like")


def _share(piece: Column, chars: str) -> Column:
    return 1 - F.length(F.regexp_replace(piece, f"[{chars}]", "")) / F.length(piece)


def _features(piece: Column, before: Column, after: Column, path: Column, dictionary: str) -> Column:
    classes = piece
    for chars, name in (("a-z", "l"), ("A-Z", "u"), ("0-9", "d"), ("_+/=-", "s")):
        classes = F.regexp_replace(classes, f"[{chars}]", {"l": "\u0001", "u": "\u0002", "d": "\u0003", "s": "\u0004"}[name])
    runs = F.length(F.regexp_replace(classes, "(.)\\1*", "r"))
    n = F.length(piece)
    near_before, near_after = F.right(before, F.lit(NEAR)), F.left(after, F.lit(NEAR))
    flag = lambda c: c.cast("double")
    values = {
        "length": F.least(n, F.lit(200)).cast("double"),
        "digits": _share(piece, "0-9"), "uppers": _share(piece, "A-Z"), "lowers": _share(piece, "a-z"),
        "symbols": _share(piece, "_+/=-"),
        "changes": (runs - 1) / n,
        "distinct": F.size(F.array_distinct(F.split(F.lower(piece), ""))) / F.least(n, F.lit(37)),
        "longest_letters": F.array_max(F.transform(F.split(piece, "[^A-Za-z]+"), F.length)) / n,
        "hex": flag(piece.rlike("^[0-9a-f]+$|^[0-9A-F]+$")),
        "covered": 1 - F.length(F.regexp_replace(F.lower(piece), dictionary, "")) / n,
        "named": flag(near_before.rlike(_NAMES)),
        "assigned": flag(near_before.rlike(_ASSIGNED)),
        "quoted": flag(near_before.rlike("[\"'`]$") & near_after.rlike("^[\"'`]")),
        "starts_line": flag((before == "") | before.endswith("\n")),
        "plain_before": flag(near_before.rlike("[A-Za-z]{2,}[.,;:]?\\s+$")),
        "plain_after": flag(near_after.rlike("^[.,;:]?\\s+[A-Za-z]{2,}")),
        "path_test": flag(F.coalesce(path.rlike(_TEST_PATH), F.lit(False))),
        "path_like": flag(piece.rlike("/.*/|^/")),
    }
    return F.array(*[values[f] for f in FEATURES])


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that is computed once per row: a generator, unlike a projection, is not
    copied into the expressions that use it (inside a lambda that would be once per element)."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def _cut_run(run: Column) -> Column:
    """A run's parts: names and values apart from the = between them, provider formats apart from what is beside them."""
    marked = F.regexp_replace(F.regexp_replace(run, "(=+)(?=[^=])", f"{_CUT}$1{_CUT}"), _FORMAT_INSIDE, f"{_CUT}$1{_CUT}")
    inside = run.rlike(_IS_CANDIDATE) & (run.rlike("=[^=]") | run.rlike(_FORMAT_INSIDE))
    return F.when(inside, F.filter(F.split(marked, _CUT), lambda x: x != "")).otherwise(F.array(run))


def judged_pieces(docs: DataFrame, text: str, path: str | None, pattern: str, score=None) -> DataFrame:
    """Adds ``__pieces``: structs (piece, before, features, score) of the text's pieces; features
    and score are null for a piece that is no candidate, all is null for a text without any."""
    df = docs.withColumn("__path", _path(docs, path))
    some = F.col(text).rlike(f"[{_CHARS}]{{{MIN_LENGTH}}}|{_DIRECT}{_VALUE}{{{SHORT}}}|{_USER}{_URI_PASSWORD}@")
    df = _once(df, "__runs", F.when(some, F.split(F.col(text), f"{_BORDER}|{_SHORT_BORDER}|{_URI_BORDER}")))
    df = _once(df, "__cut", F.flatten(F.transform("__runs", _cut_run)))
    cut = F.col("__cut")
    beside = lambda i: F.coalesce(F.get(cut, i), F.lit(""))
    # a name that is a piece of its own belongs to the text before its value, as does the part of a token before a dot
    df = _once(df, "__around", F.transform(cut, lambda x, i: F.struct(
        x.alias("piece"),
        F.when(beside(i - 1).rlike(_ASSIGNS) | (beside(i - 1) == ".") | (beside(i - 1).rlike("^[\"'`]$") & beside(i - 2).endswith("=")),
               F.concat(beside(i - 2), beside(i - 1)))
        .otherwise(beside(i - 1)).alias("before"),
        beside(i + 1).alias("after"))))
    described = F.transform("__around", lambda x: F.struct(
        x.piece.alias("piece"), x.before.alias("before"), x.after.alias("after"),
        F.when(x.piece.rlike(_IS_CANDIDATE) | (x.piece.rlike(_IS_SHORT) & F.right(x.before, F.lit(NEAR)).rlike(f"{_DIRECT}$"))
               | (x.after.startswith("@") & x.before.rlike(f"{_USER}$")),
               _features(x.piece, x.before, x.after, F.col("__path"), pattern)).alias("features")))
    df = _once(df, "__described", described)
    if score is None:
        return df.withColumnRenamed("__described", "__pieces").drop("__runs", "__cut", "__around")
    scored = F.expr("transform(__described, x -> struct(x.piece as piece, x.before as before, x.features as features, "
                    f"if(x.features is null, null, if(x.piece rlike '{_FORMATS}' "
                    f"or (x.piece rlike '{_JWT}' and startswith(x.after, '.')) or x.before rlike '{_AFTER_JWT}' "
                    f"or (not x.piece rlike '{_PLACEHOLDER}' and ((length(x.piece) < {MIN_LENGTH} and x.piece rlike '{_MIXED}') "
                    f"or (startswith(x.after, '@') and x.before rlike '{_USER}$'))), "
                    f"1.0D, {score('x.features')})) as score))")
    return _once(df, "__pieces", scored).drop("__runs", "__cut", "__around", "__described")


def _path(df: DataFrame, path: str | None) -> Column:
    return F.col(path).cast("string") if path in df.columns else F.lit(None).cast("string")


def _sample(docs: DataFrame, key: str, size: int) -> DataFrame:
    n = docs.count()
    drawn = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit("secrets")), F.lit(1 << 30)) / float(1 << 30)
    return docs.where(drawn < (min(1.0, size / n) if n else 1.0))


def _trie_pattern(words: list[str]) -> str:
    """Pattern of the words, the longest first at every place, which reads each letter once."""
    root: dict = {}
    for w in words:
        node = root
        for c in w:
            node = node.setdefault(c, {})
        node[""] = {}

    def rest(node: dict) -> str:
        ways = [c + rest(node[c]) for c in sorted(node) if c]
        if not ways:
            return ""
        return ("(?:" + "|".join(ways) + ")" if len(ways) > 1 or "" in node else ways[0]) + ("?" if "" in node else "")

    return rest(root) or "(?!)"


def dictionary(docs: DataFrame, text: str, share: int = DICTIONARY_SHARE) -> str:
    """Pattern of the words of 4 to 12 lower-case letters that make up one in ``share`` of all such words."""
    words = docs.select(F.explode(F.split(F.lower(text), "[^a-z]+")).alias("w")).where(F.length("w").between(4, 12))
    counts = write_stage(words.groupBy("w").agg(F.count("*").alias("n")), "secret-words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    return _trie_pattern([r.w for r in counts.where(F.col("n") * share >= total).select("w").collect()])


def _planted(sample: DataFrame) -> DataFrame:
    """Excerpts (__key, __source, text) of the sample with one planted value each: __value, label."""
    rows = _once(sample.withColumn("__nth", F.explode(F.sequence(F.lit(0), F.lit(PER_DOCUMENT - 1)))), "__id",
                 F.concat_ws(":", F.coalesce("__key", F.lit("null")), F.xxhash64("__text").cast("string"), F.col("__nth").cast("string")))
    number = lambda name, n: F.pmod(F.xxhash64("__id", F.lit(name)), F.lit(n)).cast("int")
    pick = lambda name, values: F.element_at(F.array(*[F.lit(v) for v in values]), number(name, len(values)) + 1)
    digest = lambda name: F.sha2(F.concat("__id", F.lit(name)), 256)
    rows = _once(rows, "__excerpt", F.substring("__text", F.pmod(F.xxhash64("__id"), F.greatest(F.length("__text") - 300, F.lit(1))).cast("int") + 1,
                                                F.lit(300)))
    rows = _once(rows, "__words", F.filter(F.split(F.lower("__excerpt"), "[^a-z]+"), lambda w: F.length(w).between(4, 9)))
    word = lambda name: F.coalesce(F.get("__words", F.pmod(F.xxhash64("__id", F.lit(name)), F.greatest(F.size("__words"), F.lit(1))).cast("int")),
                                   pick(name, ["value", "string", "required", "setting", "default"]))
    rows = _once(rows, "__w", F.array(*[word(f"w{i}") for i in range(4)]))
    w = lambda i: F.col("__w")[i]
    rows = _once(rows, "__hex", F.when(number("case", 5) == 0, F.upper(F.concat(digest("a"), digest("b")))).otherwise(F.concat(digest("a"), digest("b"))))
    rows = _once(rows, "__base", F.regexp_replace(F.base64(F.unhex(F.concat(digest("c"), digest("d")))), "[=\\s]", ""))
    hexa = F.left("__hex", pick("size", [32, 40, 64]))
    dense = F.regexp_replace("__base", "[+/]", "")
    digits = F.regexp_replace("__hex", "[^0-9]", "")
    quote = pick("quote", ['"', "'", "", "`"])
    name = pick("name", ["token", "secret", "password", "api_key", "access_key", "auth_token", "client_secret", "passwd", "credential"])
    lead = F.concat(F.when(number("upper", 4) == 0, F.upper(name)).otherwise(name), pick("assign", [" = ", "=", ": ", ":"]), quote)
    none, joint = F.lit(""), pick("joint", ["_", "-", "/"])
    secrets = [
        (lead, hexa, quote), (lead, F.left(dense, 16 + number("long", 48)), quote), (lead, F.left(dense, 8 + number("short", 8)), quote),
        (lead, F.concat(w(0), F.left(digits, 1 + number("digits", 3)), w(1)), quote),
        (F.lit("Authorization: Bearer "), F.left(dense, 24 + number("bearer", 50)), none),
        (pick("pem", ["PRIVATE KEY-----\n", "\n", "\n"]), F.left("__base", F.lit(64)), F.lit("\n")),
    ]
    hard = [
        (pick("sum", ["sha256 ", "sha1: ", "checksum ", "commit ", "md5 ", "revision ", "digest: ", 'etag "', "hash = ", ""]), hexa, pick("end", ["", ".", '"'])),
        (pick("uuid", ["id ", "uuid: ", "request ", "session ", ""]), F.regexp_replace(F.left("__hex", F.lit(32)), "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-"), none),
        (none, F.concat(w(0), joint, w(1), joint, w(2), joint, w(3)), none),
        (none, F.concat(F.lit("/"), w(0), F.lit("/"), w(1), F.lit("/"), F.left("__hex", F.lit(8))), none),
        (lead, F.concat(w(0), w(1)), quote), (lead, F.concat_ws("_", w(0), w(1), w(2)), quote),
        (lead, pick("dummy", ["your_api_key_here", "changeme_changeme", "xxxxxxxxxxxxxxxxxxxx", "example_token_1234567",
                              "REPLACE_WITH_TOKEN", "insert-your-password"]), quote),
        (none, F.left(digits, 16 + number("count", 5)), none),
    ]
    choice = lambda name, kinds: F.element_at(F.array(*[F.struct(a.alias("a"), v.alias("v"), z.alias("z")) for a, v, z in kinds]),
                                              number(name, len(kinds)) + 1)
    rows = _once(rows, "__plant", F.when(F.col("__nth") % 2 == 0, choice("secret", secrets)).otherwise(choice("hard", hard)))
    plain = lambda c: F.regexp_replace(c, "[A-Za-z0-9_+/=-]{12,}|[=:\"'`]", "")
    return rows.select("__key", "__source", F.col("__plant.v").alias("__value"), (1.0 - F.col("__nth") % 2).alias("label"),
                       F.concat(plain(F.left("__excerpt", F.lit(150))), pick("gap", [" ", " ", "\n"]), "__plant.a", "__plant.v", "__plant.z",
                                pick("next", [" ", "\n", ", "]), plain(F.right("__excerpt", F.lit(150)))).alias("__text"))


def labelled(sample: DataFrame, text: str, key: str, path: str | None, pattern: str) -> DataFrame:
    """(features, label) of values planted in the sample's texts, and of its own candidates whose kind is plain."""
    own = sample.select(F.col(key).cast("string").alias("__key"), F.col(text).alias("__text"), _path(sample, path).alias("__source"))
    candidate = F.explode(F.filter("__pieces", lambda x: x.features.isNotNull())).alias("c")
    planted = (judged_pieces(_planted(own), "__text", "__source", pattern).select("__value", "label", candidate)
               .where(F.col("c.piece") == F.col("__value")).select("c.features", "label"))
    piece = F.col("c.piece")
    plain = piece.rlike("^[0-9]+$|^[a-z]+$|^[A-Z][a-z]+$|^[A-Z]+$") | piece.rlike("(?i)^[a-z]+([-_/][a-z]+)+$")
    label = (F.when(piece.rlike(_PLACEHOLDER), 0.0).when(piece.rlike(_FORMATS), 1.0)
             .when(plain | piece.rlike("^(.)\\1+$"), 0.0))
    found = judged_pieces(own, "__text", "__source", pattern).select(candidate).withColumn("label", label)
    return planted.unionByName(found.where("label is not null").select("c.features", "label"))


class Forest:
    """Fitted trees as SQL: the share of trees that vote for a secret, from a features array."""

    def __init__(self, votes: list[str], pattern: str):
        self.votes, self.pattern = votes, pattern

    def score(self, features: str) -> str:
        return "(" + " + ".join(v.replace("$f", features) for v in self.votes) + f") / {float(len(self.votes))}"


def _tree_sql(node) -> str:
    if node.getClass().getSimpleName() == "LeafNode":
        return f"{float(node.prediction())}D"
    split = node.split()
    return (f"if($f[{split.featureIndex()}] <= {float(split.threshold())!r}D, "
            f"{_tree_sql(node.leftChild())}, {_tree_sql(node.rightChild())})")


def train(docs: DataFrame, text: str = "text", key: str = "doc_id", path: str | None = "source",
          findings: DataFrame | None = None, sample: int = SAMPLE_DOCUMENTS, seed: int = 6) -> Forest:
    """Fit the forest; ``findings`` (features, label) replaces the findings labelled by rule."""
    chosen = _sample(docs.where(F.col(text).isNotNull()), key, sample)
    pattern = dictionary(docs, text)
    rows = findings if findings is not None else labelled(chosen, text, key, path, pattern)
    order = ["label", "features"]
    rows = write_stage(rows.select(*order), "secret-findings")
    kinds = {r.label for r in rows.select("label").distinct().collect()}
    if kinds != {0.0, 1.0}:
        return Forest([f"{max(kinds, default=0.0)}D"], pattern)
    # one sorted partition: the fit does not depend on how the sample was dealt out
    fit_on = rows.repartition(1).sortWithinPartitions(*order)
    weight = rows.where("label = 0").count() / max(1, rows.where("label = 1").count())
    fit_on = fit_on.select("label", F.when(F.col("label") == 1, F.lit(float(weight))).otherwise(F.lit(1.0)).alias("weight"),
                           *[F.col("features")[i].alias(f) for i, f in enumerate(FEATURES)])
    forest = RandomForestClassifier(featuresCol="vector", weightCol="weight", numTrees=TREES, maxDepth=DEPTH, seed=seed)
    model = forest.fit(VectorAssembler(inputCols=list(FEATURES), outputCol="vector").transform(fit_on))
    return Forest([_tree_sql(t._java_obj.rootNode()) for t in model.trees], pattern)


def scan(docs: DataFrame, forest: Forest, text: str = "text", path: str | None = "source") -> DataFrame:
    """All columns of ``docs`` with ``secrets``: an array of (nth, piece, score), nth being the
    1-based place among the pieces; and ``clean``: the text with secrets masked."""
    names = [F.col(f"`{c}`") for c in docs.columns if c not in ("secrets", "clean")]
    judged = judged_pieces(docs, text, path, forest.pattern, forest.score)
    found = F.filter(F.transform("__pieces", lambda x, i: F.struct((i + 1).alias("nth"), x.piece.alias("secret"),
                                                                   x.score.alias("score"))),
                     lambda x: x.score >= THRESHOLD)
    masked = F.array_join(F.transform("__pieces", lambda x: F.when(x.score >= THRESHOLD, F.lit(MASK)).otherwise(x.piece)), "")
    none = F.array().cast("array<struct<nth:int,secret:string,score:double>>")
    return judged.select(*names, F.coalesce(found, none).alias("secrets"),
                         F.when(F.exists("__pieces", lambda x: x.score >= THRESHOLD), masked)
                         .otherwise(F.col(text)).alias("clean"))
