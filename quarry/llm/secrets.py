"""Secret scans: candidates by pattern, false positives removed by a random forest.

DataFrame operations only. A text's candidates are private key blocks up to their END
line, values assigned to a credential's name (a quoted one up to its closing quote in
the line), and long runs of token characters with a digit; each comes with what stands
before and after it. Features (``FEATURES``) are

* the candidate's length and kinds of characters;
* its character transitions: how likely its letters follow each other by a table of
  letter pairs, counted in the words of the corpus;
* dictionary coverage: the share of its characters that lie in a word of the corpus
  (``dictionary``: the ``WORDS`` words with the highest document frequency, counted over all texts);
* the path (the document's source);
* the neighbouring words: the sum of the log odds that the two words before the candidate
  have in the labelled findings, and whether names of credentials, examples or a call stand there.

The forest is trained on labelled findings: those the caller gives, else findings planted
in short texts of corpus words (``planted``). There the label belongs to what was planted
and not to the features: random values of one kind are secrets behind a credential's name
and none behind ``commit`` or ``sha256`` or in a tutorial; calls and placeholders behind such
a name are none. At most
``SAMPLE`` findings of each label are fitted, chosen by a hash of the finding.
Whole texts are scanned, all findings scored.

Defined results: a null or empty text has no findings; findings are numbered in
the order of the text; a null doc_id or source is kept as null; copies of a row
have the same findings each; findings whose hashes tie are sampled by text and number; if the
labelled findings have one label only, it is the score (none at all: 0); an empty table gives an
empty result; a text of any length is scanned whole; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StopWordsRemover, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep

SAMPLE, TREES, DEPTH, SEED, THRESHOLD = 5000, 30, 8, 6, 0.5
#: Findings planted for training; words of the dictionary, the least documents that hold one, their letters.
PLANTED, WORDS, LEAST_DOCS, SHORTEST, LONGEST = 6000, 20_000, 3, 4, 12
#: Neighbouring words with log odds: so many at most, each in so many labelled findings at least.
NEIGHBOURS, LEAST_FINDINGS = 200, 20
MASK = "[SECRET]"

#: Names that credentials are assigned to.
NAMES = r"(?:password|passwd|passphrase|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credential)"
_KEY = r"[A-Z0-9 ]{0,30}PRIVATE KEY(?: BLOCK)?-----"
_BLOCK = rf"-----BEGIN {_KEY}(?:(?!-----(?:BEGIN |END {_KEY}))[\s\S])*+-----END {_KEY}"
_NAMED = r"(?i:" + NAMES + r")[A-Za-z0-9_-]{0,20}[\"']?\s{0,2}[:=]{1,2}+\s{0,2}+"
#: A quote ends a value if an even number of backslashes stands before it.
_ENDS = r"(?<!(?<!\\)(?:\\\\){0,99}\\)"
_QUOTED = "|".join(rf"{q}(?!{_BLOCK})(?:(?!{_ENDS}{q})[^\r\n]){{6,}}+(?={q})" for q in "\"'")
_ASSIGNED = rf"{_NAMED}(?:{_QUOTED}|[\"']?(?!{_BLOCK})[^\s\"',;<>]{{6,}}+)"
_RUN = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{16,}+={0,2}"
#: Formats of known issuers' credentials.
_ISSUED = r"(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|[sr]k_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}|eyJ[A-Za-z0-9_-]{10,})"
ISSUED = f"^(?:{_ISSUED}|-----BEGIN )"
CANDIDATE = f"{_BLOCK}|{_ASSIGNED}|(?<![A-Za-z0-9+/_-]){_ISSUED}(?![A-Za-z0-9])|{_RUN}"
#: Placeholders, and words of paths and neighbourhoods that hold examples.
PLACEHOLDERS = ["example", "changeme", "password", "placeholder", "your", "dummy", "sample", "secret", "token", "redacted", "xxxx", "1234567890", "abcdef"]
_EXAMPLES = r"(?:example|sample|dummy|fake|test|mock|fixture|demo|tutorial|docs?)"

FEATURES = ["length", "digits", "upper", "lower", "symbols", "hexadecimal", "changes", "transitions", "distinct", "dictionary", "placeholder",
            "assigned", "issued", "quoted", "call", "named_before", "example_before", "example_path", "path_depth", "words_before", "neighbours"]


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, source, text_key, nth, value, assigned, before, after."""
    found = F.regexp_extract_all("text", F.lit(f"({CANDIDATE})"), F.lit(1))
    d = docs.filter(F.col("text").rlike(CANDIDATE)).select(F.col("doc_id").cast("long").alias("doc_id"), "source", F.sha2("text", 256).alias("text_key"),
                                                         found.alias("found"), F.split("text", CANDIDATE, -1).alias("rest"))
    before = F.transform(F.slice("rest", F.lit(1), F.size("found")), lambda s: F.right(s, F.lit(60)))
    after = F.transform(F.slice("rest", F.lit(2), F.size("found")), lambda s: F.left(s, F.lit(20)))
    d = d.select("doc_id", "source", "text_key", F.posexplode(F.arrays_zip(F.col("found").alias("found"), before.alias("before"), after.alias("after"))).alias("nth", "c"))
    assigned = F.regexp_extract("c.found", rf"^{_NAMED}[\"']?([\s\S]{{6,}})$", 1)
    d = d.withColumn("assigned", (assigned != "")).withColumn("value", F.when(assigned != "", assigned).otherwise(F.col("c.found")))
    return d.select("doc_id", "source", "text_key", "nth", "value", "assigned", F.col("c.before").alias("before"), F.col("c.after").alias("after"))


# ------------------------------------------------------------------ what the corpus tells


def dictionary(docs: DataFrame) -> DataFrame:
    """word, docs: the ``WORDS`` most frequent words by the number of texts that hold them, and the stop words.

    Only letters between white space, brackets, quotes and punctuation make a word, so no piece of a longer token does.
    """
    own = F.regexp_extract_all(F.lower("text"), F.lit(rf"(?<![^\s(\"'])([a-z]{{{SHORTEST},{LONGEST}}})(?![^\s.,;:!?)\"'])"), F.lit(1))
    words = docs.select(F.explode_outer(F.array_distinct(own)).alias("word")).groupBy("word").agg(F.count("*").alias("docs"))
    words = words.filter(F.col("word").isNotNull() & (F.col("docs") >= LEAST_DOCS)).orderBy(F.desc("docs"), "word").limit(WORDS)
    fixed = {w for name in ("english", "german", "french", "spanish") for w in StopWordsRemover.loadDefaultStopWords(name)}
    fixed = sorted(w for w in fixed if SHORTEST <= len(w) <= LONGEST and w.isascii() and w.isalpha() and w.islower())
    fixed = docs.sparkSession.createDataFrame([(w, 0) for w in fixed], "word string, docs long")
    return keep(words.union(fixed).groupBy("word").agg(F.max("docs").alias("docs")))


def transitions(words: DataFrame) -> list[float]:
    """log2 of the probability that a character follows another, 27 * 27 of them (0: no letter, then a to z)."""
    letters = F.split("word", "")
    pairs = F.zip_with(F.concat(F.array(F.lit(" ")), letters), F.concat(letters, F.array(F.lit(" "))), lambda x, y: _code(x) * 27 + _code(y))
    counts = words.select(F.explode(pairs).alias("pair")).groupBy("pair").count().collect()  # 729 at most
    n = {r.pair: r["count"] for r in counts}
    total = [sum(n.get(27 * i + j, 0) for j in range(27)) for i in range(27)]
    return [math.log2((n.get(27 * i + j, 0) + 0.5) / (total[i] + 13.5)) for i in range(27) for j in range(27)]


def _code(c: F.Column) -> F.Column:
    return F.when(c.between("a", "z") & (F.length(c) == 1), F.ascii(c) - 96).otherwise(0)


def _coverage(found: DataFrame, words: DataFrame) -> DataFrame:
    """_value, covered: characters of each distinct value that lie in a word of the dictionary."""
    d = found.select("value").distinct()
    ahead = F.regexp_extract_all(F.lower("value"), F.lit(rf"(?=([a-z]{{1,{LONGEST}}}))"), F.lit(1))
    d = d.select(F.sha2("value", 256).alias("_value"), F.posexplode_outer(ahead).alias("at", "ahead")).filter(F.length("ahead") >= SHORTEST)
    d = d.withColumn("n", F.explode(F.sequence(F.lit(SHORTEST), F.length("ahead")))).withColumn("word", F.expr("left(ahead, n)"))
    d = d.join(F.broadcast(words.select("word")), "word")  # WORDS and the stop words at most
    d = d.select("_value", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("n") - 1)).alias("at")).distinct()
    return d.groupBy("_value").agg(F.count("*").alias("covered"))


# ------------------------------------------------------------------ features


def _share(pattern: str) -> F.Column:
    return (F.regexp_count("value", F.lit(pattern)) / F.length("value")).cast("double")


def _words_before() -> F.Column:
    return F.slice(F.reverse(F.regexp_extract_all(F.lower("before"), F.lit(r"[a-z][a-z0-9]+"), F.lit(0))), 1, 2)


def with_features(found: DataFrame, words: DataFrame, table: list[float]) -> DataFrame:
    """All features but ``neighbours``, which takes labelled findings."""
    n, flag = F.length("value"), lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    source = F.coalesce(F.col("source").cast("string"), F.lit(""))
    code = F.transform(F.split(F.lower("value"), ""), _code)
    odds = F.array(*[F.lit(x) for x in table])
    pairs = F.zip_with(code, F.slice(code, F.lit(2), F.size(code)), lambda x, y: F.element_at(odds, (x * 27 + F.coalesce(y, F.lit(0)) + 1).cast("int")))
    features = {
        "length": n.cast("double"), "digits": _share("[0-9]"), "upper": _share("[A-Z]"), "lower": _share("[a-z]"), "symbols": _share("[^A-Za-z0-9]"),
        "hexadecimal": _share("[0-9a-fA-F]"), "changes": (F.regexp_count("value", F.lit("[a-z]+|[A-Z]+|[0-9]+|[^A-Za-z0-9]+")) - 1) / n,
        "transitions": F.aggregate(pairs, F.lit(0.0), lambda x, y: x + y) / n,
        "distinct": F.size(F.array_distinct(F.split("value", ""))) / n,
        "placeholder": 1 - F.length(F.regexp_replace(F.lower("value"), "|".join(PLACEHOLDERS), "")) / n,
        "issued": flag(F.col("value").rlike(ISSUED)), "quoted": flag(F.col("after").rlike("^[\"']")),
        "call": flag(F.col("value").rlike(r"^\$?[\p{L}_][\w.>:-]*[(\[{]") | F.col("after").rlike(r"^[(\[]")),
        "named_before": flag(F.col("before").rlike("(?i)" + NAMES + r"\W{0,4}\w{0,12}\W{0,4}$")),
        "example_before": flag(F.col("before").rlike(rf"(?i)\b{_EXAMPLES}\W{{0,3}}$") | F.col("after").rlike(rf"(?i)^\W{{0,3}}{_EXAMPLES}\b")),
        "example_path": flag(source.rlike(rf"(?i)\b{_EXAMPLES}s?\b")), "path_depth": flag(F.regexp_count(source, F.lit("[/\\\\]"))),
        "words_before": flag(F.regexp_count("before", F.lit(r"[\p{L}]{2,}"))),
    }
    found = found.withColumns(features).withColumn("assigned", F.col("assigned").cast("double")).withColumn("_value", F.sha2("value", 256))
    found = found.join(_coverage(found, words), "_value", "left").drop("_value")
    return found.withColumn("dictionary", F.coalesce(F.col("covered"), F.lit(0)) / n).drop("covered")


def neighbours(labelled: DataFrame) -> dict[str, float]:
    """Log odds of words before labelled findings: the ``NEIGHBOURS`` that tell most."""
    n = labelled.select("label", F.explode(F.array_distinct(_words_before())).alias("word")).groupBy("word").agg(F.count("*").alias("n"), F.sum("label").alias("ones"))
    odds = F.log((F.col("ones") + 1) / (F.col("n") - F.col("ones") + 1))
    rows = n.filter(F.col("n") >= LEAST_FINDINGS).select("word", odds.alias("odds")).orderBy(F.desc(F.abs("odds")), "word").limit(NEIGHBOURS).collect()
    return {r.word: r.odds for r in rows}


def _with_neighbours(found: DataFrame, odds: dict[str, float]) -> DataFrame:
    if not odds:
        return found.withColumn("neighbours", F.lit(0.0))
    of = F.create_map(*[F.lit(x) for pair in sorted(odds.items()) for x in pair])
    return found.withColumn("neighbours", F.aggregate(_words_before(), F.lit(0.0), lambda x, w: x + F.coalesce(F.element_at(of, w), F.lit(0.0))))


# ------------------------------------------------------------------ labelled findings


def planted(words: DataFrame, first: int = 0, rows: int = PLANTED) -> DataFrame:
    """Findings with a ``label``: values number ``first`` and on, planted in short texts of frequent words."""
    common = [r.word for r in words.orderBy(F.desc("docs"), "word").limit(200).collect()] or ["words"]
    draw = lambda k, n: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(n)).cast("int")
    one = lambda k, options: F.element_at(F.array(*[F.lit(x) for x in options]), draw(k, len(options)) + 1)
    word = lambda k: one(k, common)
    hexa = F.concat(F.sha2(F.concat(F.lit("a"), "id"), 256), F.sha2(F.concat(F.lit("b"), "id"), 256))
    mixed = F.regexp_replace(F.base64(F.unhex(hexa)), "[^A-Za-z0-9]", "")
    cut = lambda c, k, low, high: F.substring(c, F.lit(1), draw(k, high - low + 1) + low)
    hex_run, mixed_run = cut(hexa, 1, 18, 64), F.concat(cut(mixed, 2, 18, 48), draw(3, 10).cast("string"))
    small = F.lower(F.concat(cut(mixed, 4, 7, 14), draw(3, 10).cast("string")))
    strong = F.concat(cut(mixed, 5, 4, 8), one(6, [";", "!", "$", "%", "#x", ", k", "<", "."]), F.reverse(cut(mixed, 7, 3, 8)), draw(3, 10).cast("string"))
    digits = F.translate(cut(hexa, 8, 16, 30), "abcdef", "012345")
    uuid = F.regexp_replace(F.substring(hexa, 1, 32), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    name = one(9, ["password", "passwd", "secret", "token", "api_key", "apikey", "access_key", "auth_token", "db_password", "client_secret", "credential"])
    equal = one(10, ["=", " = ", ": ", ":", " := "])
    hashed = one(11, ["commit ", "sha256: ", "sha1 ", "md5 ", "checksum: ", "digest ", "etag ", "revision ", "hash ", "merge ", "tree ", "object ", "integrity "])
    issued = F.element_at(F.array(F.concat(F.lit("AKIA"), F.upper(F.substring(mixed, 1, 16))), F.concat(F.lit("ghp_"), F.substring(mixed, 1, 36)),
                                  F.concat(F.lit("sk_live_"), F.substring(mixed, 1, 24)), F.concat(F.lit("eyJ"), mixed_run)), draw(12, 4) + 1)
    block = F.concat(F.lit("-----BEGIN RSA PRIVATE KEY-----\n"), mixed, F.lit("\n"), hexa, F.lit("\n-----END RSA PRIVATE KEY-----"))
    call = F.concat(one(13, ["get_", "load_", "os.getenv", "env.", "read", "config.", "fetch_"]), word(14), draw(15, 99).cast("string"), one(16, ["(", "[", "()"]))
    path = F.concat(word(14), F.lit("/"), word(17), one(18, ["/v", "-", "_"]), draw(15, 99).cast("string"), F.lit("/"), word(19), F.lit("-"), word(20))
    holder = one(21, ["changeme", "your_token_here", "example123456", "xxxxxxxxxxxx", "placeholder1", "password123456", "your-secret-key", "dummy_value"])
    two = F.concat(word(14), one(18, ["", "_", "-"]), word(17))
    quote = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    known = F.concat(name, equal)
    example = F.concat(one(22, ["example ", "dummy ", "sample ", "fake "]), name, equal)
    plain = F.lit("src/main.py")
    kinds = [  # label, text, path
        (1, F.concat(known, hex_run), plain), (1, F.concat(known, quote(hex_run)), plain), (1, F.concat(known, mixed_run), plain), (1, F.concat(known, quote(mixed_run)), plain),
        (1, F.concat(known, small), plain), (1, F.concat(known, quote(small)), plain), (1, F.concat(known, quote(strong)), plain), (1, issued, plain), (1, F.concat(known, issued), plain),
        (1, block, plain), (1, F.concat(name, F.lit(" is "), mixed_run), plain), (1, F.concat(known, quote(hex_run)), plain), (1, issued, F.lit("notes")),
        (0, F.concat(hashed, hex_run), plain), (0, F.concat(hashed, quote(mixed_run)), plain), (0, F.concat(hashed, F.substring(hexa, 1, 40)), plain), (0, uuid, plain),
        (0, F.concat(one(23, ["id ", "uuid: ", "request "]), uuid), plain), (0, digits, plain), (0, F.concat(word(24), F.lit(" "), digits), plain), (0, path, plain),
        (0, F.concat(known, holder), plain), (0, F.concat(known, quote(holder)), plain), (0, F.concat(known, call), plain), (0, F.concat(known, call, F.lit('"KEY")')), plain),
        (0, F.concat(known, two), plain), (0, F.concat(known, quote(two)), plain), (0, F.concat(known, quote(mixed_run)), F.lit("docs/tutorial.md")),
        (0, F.concat(known, hex_run), F.lit("tests/fixtures/a.py")), (0, F.concat(known, F.concat(F.lit("/"), path)), plain), (0, F.concat(example, hex_run), plain),
        (0, F.concat(two, F.lit("_"), path), plain), (0, F.concat(hashed, hexa), plain), (0, F.concat(known, digits), plain)]
    # a path as in a table, none, or one of code: it tells nothing but for examples
    source = F.when(F.col("k.path") != "src/main.py", F.col("k.path")).otherwise(one(25, ["src/main.py", "src0", "a/b/c.txt", None, "notes", "web"]))
    k = F.element_at(F.array(*[F.struct(F.lit(float(v)).alias("label"), t.alias("text"), p.alias("path")) for v, t, p in kinds]), (F.col("id") % len(kinds) + 1).cast("int"))
    lead = F.concat_ws(" ", word(26), word(27), word(28))
    texts = words.sparkSession.range(first, first + rows, 1, 4).withColumn("k", k)
    texts = keep(texts.select(F.col("id").alias("doc_id"), source.alias("source"), F.concat(lead, F.lit(" "), F.col("k.text"), F.lit(" "), word(29), F.lit(" "), word(30)).alias("text"), "k.label"))
    return candidates(texts).join(texts.select("doc_id", "label"), "doc_id")


# ------------------------------------------------------------------ the forest


def train(labelled: DataFrame):
    """A forest from findings with features and ``label``, and the odds of neighbours; a label in its place if no other occurs."""
    order = F.xxhash64(F.lit(SEED), "text_key", "nth")
    parts = [labelled.filter(F.col("label") == v).orderBy(order, "text_key", "nth").limit(SAMPLE) for v in (0.0, 1.0)]
    rows = keep(parts[0].union(parts[1]).select(*[c for c in FEATURES if c != "neighbours"], "before", "label"))
    labels = [r.label for r in rows.select("label").distinct().collect()]
    if len(labels) < 2:
        return (labels or [0.0])[0], {}
    odds = neighbours(rows)
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    return forest.fit(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(_with_neighbours(rows, odds))), odds


def judged(found: DataFrame, model, odds: dict[str, float]) -> DataFrame:
    """``found`` with its features, score and is_secret."""
    if isinstance(model, float):
        found = found.withColumn("neighbours", F.lit(0.0)).withColumn("score", F.lit(model))
    else:
        found = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(_with_neighbours(found, odds)))
        found = found.withColumn("score", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")
    return found.withColumn("is_secret", F.col("score") >= THRESHOLD)


def scored(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """All findings with their value, features, score and is_secret.

    ``labelled``: findings of this shape (value, source, before, after, assigned,
    text_key, nth) with a ``label`` to train on, in place of the planted ones.
    """
    words = dictionary(docs)
    table = transitions(words)
    model, odds = train(with_features(labelled if labelled is not None else keep(planted(words)), words, table))
    return judged(keep(with_features(keep(candidates(docs)), words, table)), model, odds)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, nth, kind, n_chars, value_sha256, score, is_secret of every finding."""
    kind = F.when(F.col("issued") == 1, "issued").when(F.col("assigned") == 1, "assigned").otherwise("run")
    return scored(docs).select("doc_id", "nth", kind.alias("kind"), F.length("value").alias("n_chars"), F.sha2("value", 256).alias("value_sha256"),
                               F.round("score", 6).alias("score"), "is_secret")


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret, where it was found, replaced by a mask (and n_chars, where there is one, counted anew).

    Copies of a text under several paths are masked alike: where one of them holds a secret.
    """
    of = scored(docs).groupBy(F.col("text_key").alias("_key"), "nth").agg(F.max(F.when(F.col("is_secret"), F.length("value")).otherwise(0)).alias("n"))
    # of one text; in the order of its findings
    of = of.groupBy("_key").agg(F.array_sort(F.collect_list(F.struct("nth", "n"))).alias("_found"), F.max("n").alias("most")).filter("most > 0").drop("most")
    d = docs.select(F.struct(*docs.columns).alias("_row"), F.sha2("text", 256).alias("_text_key")).join(keep(of), F.col("_text_key") == F.col("_key"), "left")
    text = F.col("_row.text")
    found = F.zip_with(F.regexp_extract_all(text, F.lit(f"({CANDIDATE})"), F.lit(1)), "_found", lambda v, f: F.when(
        f["n"] > 0, F.concat(F.left(v, F.length(v) - f["n"]), F.lit(MASK))).otherwise(v))
    whole = F.flatten(F.zip_with(F.split(text, CANDIDATE, -1), found, lambda r, v: F.array(r, F.coalesce(v, F.lit("")))))
    d = d.withColumn("_clean", F.when(F.col("_found").isNull(), text).otherwise(F.array_join(whole, "")))
    new = {"text": F.col("_clean")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("_found").isNull(), F.col("_row.n_chars")).otherwise(F.length("_clean").cast(docs.schema["n_chars"].dataType))
    return d.select(*[new.get(c, F.col("_row").getField(c)).alias(c) for c in docs.columns])
