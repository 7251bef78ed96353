"""Secret scan: wide candidates, and a random forest that removes the false positives.

White-space separated words are cut into parts at quotes, commas, semicolons, brackets, &, \\,
= and :, and punctuation around a part is taken off. A part is a candidate of its own if it

* has a well-known format (`KNOWN`), or
* stands beside a word for credentials: as the value of such a name, or as the first part of the
  word after one (or after one and an assignment sign), or
* has `LEAST` characters or more, one of them a digit.

Of a word without such a part the whole is taken if the last rule holds for it. What has no
known format, no credential's name beside it and no digit or fewer characters is not looked at;
spaces and the signs above end a value. The name of a part is what stands before its = or :
(the one before that, if only that says credential). The forest sees

* the value's length, shares of character classes, distinct characters, class transitions;
* dictionary coverage: how much of it are words that occur around candidates of the corpus;
* the path of its document (depth, test or example folders, a hash bucket);
* the neighbouring words: words for credentials among them, assignment signs, hash buckets.

It is trained from labelled findings: rows (id, word number, label, and part to tell
parts of a word apart), of which a bounded sample is taken (`SAMPLE`, those with the smallest hash). Only DataFrame functions and the
forest of Spark's machine-learning library are used; what it gathers on the driver depends on
the forest's size and bins only.

Defined results: null texts have no candidate; null paths count as empty; rows without id are
scanned too; repeated rows give their findings each; with findings of only one label all
candidates get that label; without any, all are kept with probability 1; further columns are
ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airloom.llm.shared import stored

LEAST = 10
SAMPLE = 20_000
TREES, DEPTH, SEED = 30, 6, 42
#: A word is in the dictionary if it stands next to so many candidates.
DICTIONARY_COUNT = 3
CREDENTIAL = r"(?i)passw|pwd|secret|token|api_?-?key|apikey|auth|bearer|credential|private|access"
KNOWN = r"AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}"
SIGNS = ("=", ":", ":=", "=>")
_ENDS = r"\"'`,;{}\[\]()<>&\\"
#: A part and the signs behind it; = at the end of a value is padding and belongs to it.
PART = rf"([^{_ENDS}=:]+(?:=+(?=[.!?]*$|[,;}}\])&>]|[\"'`\\]+(?:$|[,;:}}\])&>.])))?)([{_ENDS}=:]*)"
BUCKETS = 8
FEATURES = (
    "length", "digits", "uppers", "lowers", "others", "distinct", "transitions", "longest_run", "hexadecimal",
    "coverage", "path_depth", "path_test", "path_bucket", "named", "before", "before_that", "after", "assigned",
    "before_bucket", "after_bucket",
)


def _long(text: Column) -> Column:
    return (F.length(text) >= LEAST) & text.rlike("[0-9]")


def _bare(text: Column) -> Column:
    """Without the punctuation around it."""
    return F.regexp_replace(text, r"^[^\p{L}\p{N}+/_-]+|[^\p{L}\p{N}+/_=-]+$", "")


def _beside(before: Column, before_that: Column) -> Column:
    """Whether the word before says credential, or the one before an assignment sign does."""
    return before.rlike(CREDENTIAL) | (before.isin(*SIGNS) & before_that.rlike(CREDENTIAL))


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """key, word_no, part, value, name, path, word_before, word_before_that, word_after."""
    words = docs.select(
        F.col(key).alias("key"), F.coalesce(F.col(path), F.lit("")).alias("path"), F.split(F.col(text), r"\s+").alias("words")
    )
    # an outer explode: an inner one would make the optimiser split every text twice
    placed = words.select("key", "path", "words", F.posexplode_outer("words").alias("word_no", "word"))

    def near(step: int) -> Column:
        at = F.col("word_no") + 1 + step
        return F.coalesce(F.when(at > 0, F.try_element_at("words", at)), F.lit(""))

    word = F.col("word")
    own = word.rlike(KNOWN) | (word.rlike("[=:]") & word.rlike(CREDENTIAL))
    placed = placed.filter(_long(word) | own | _beside(near(-1), near(-2)))
    placed = placed.select(
        "key", F.col("word_no").cast("long").alias("word_no"), "path", near(-1).alias("word_before"),
        near(-2).alias("word_before_that"), near(1).alias("word_after"), "word",
        F.regexp_extract_all(word, F.lit(PART), 1).alias("parts"), F.regexp_extract_all(word, F.lit(PART), 2).alias("signs"),
    )

    def name(i: Column, back: int) -> Column:
        """The part `back` places before part i, if = or : lead from it to part i."""
        leads = [F.try_element_at("signs", i - k).rlike("[=:]") for k in range(back)]
        given = F.when(i >= back, F.when(leads[0] if back == 1 else leads[0] & leads[1], F.try_element_at("parts", i - (back - 1))))
        return _bare(F.coalesce(given, F.lit("")))

    def part(x: Column, i: Column) -> Column:
        first, second = name(i, 1), name(i, 2)
        named = F.when(~first.rlike(CREDENTIAL) & second.rlike(CREDENTIAL), second).otherwise(first)
        return F.struct(i.cast("long").alias("part"), _bare(x).alias("value"), named.alias("name"))

    def wanted(x: Column) -> Column:
        beside = x["name"].rlike(CREDENTIAL) | ((x["part"] == 0) & _beside(F.col("word_before"), F.col("word_before_that")))
        return x["value"].rlike(r"[\p{L}\p{N}]") & (_long(x["value"]) | x["value"].rlike(f"^(?:{KNOWN})$") | beside)

    whole = F.struct(F.lit(0).cast("long").alias("part"), _bare(word).alias("value"), F.lit("").alias("name"))
    made = placed.withColumn("made", F.filter(F.transform("parts", part), wanted))
    made = made.withColumn("made", F.when((F.size("made") == 0) & _long(whole["value"]), F.array(whole)).otherwise(F.col("made")))
    found = made.select("key", "word_no", "path", "word_before", "word_before_that", "word_after", F.explode_outer("made").alias("x"))
    return found.filter("x IS NOT NULL").select(
        "key", "word_no", "x.part", "path", "word_before", "word_before_that", "word_after", "x.value", "x.name"
    )


def _coverage(found: DataFrame) -> DataFrame:
    """(value, coverage): share of a value's characters in dictionary words of three letters or more."""
    around = found.select(F.explode(F.array("word_before", "word_before_that", "word_after")).alias("w"))
    known = around.select(F.lower("w").alias("w")).filter(F.col("w").rlike("^[a-z]{3,}$"))
    known = known.groupBy("w").count().filter(F.col("count") >= DICTIONARY_COUNT).select("w")
    runs = found.select("value").distinct()
    runs = runs.select("value", F.explode(F.regexp_extract_all(F.lower("value"), F.lit("[a-z]{3,}"), 0)).alias("w"))
    covered = runs.join(known, "w").groupBy("value").agg(F.sum(F.length("w")).alias("n"))
    return covered.select("value", (F.col("n") / F.length("value")).alias("coverage"))


def features(found: DataFrame) -> DataFrame:
    """The candidates with the columns of FEATURES."""
    value, size = F.col("value"), F.length("value")
    digits, upper = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    classes = F.regexp_replace(F.translate(value, digits + upper + upper.lower(), "d" * 10 + "u" * 26 + "l" * 26), "[^dul]", "o")
    found = found.withColumn("classes", classes)

    def share(letter: str) -> Column:
        return (size - F.length(F.translate("classes", letter, ""))) / size

    def bucket(c: Column) -> Column:
        return F.pmod(F.xxhash64(F.lower(c)), F.lit(BUCKETS)).cast("double")

    def says(*columns: str) -> Column:
        return F.concat_ws(" ", *columns).rlike(CREDENTIAL).cast("double")

    runs = F.filter(F.split(F.regexp_replace("classes", r"(.)\1*", "$0 "), " "), lambda x: x != "")
    made = found.withColumns({
        "length": size.cast("double"),
        "digits": share("d"), "uppers": share("u"), "lowers": share("l"), "others": share("o"),
        "distinct": F.size(F.array_distinct(F.split("value", ""))) / size,
        "transitions": (F.size(runs) - 1) / size,
        "longest_run": F.aggregate(runs, F.lit(0), lambda a, x: F.greatest(a, F.length(x))) / size,
        "hexadecimal": value.rlike("^[0-9a-f]+$|^[0-9A-F]+$").cast("double"),
        "path_depth": (F.size(F.split("path", "/")) - 1).cast("double"),
        "path_test": F.col("path").rlike(r"(?i)test|example|sample|mock|fixture|demo").cast("double"),
        "path_bucket": bucket(F.col("path")),
        "named": says("name"),
        "assigned": (F.col("word_before").rlike("(?:[=:]|=>)[\"']?$") | (F.col("name") != "")).cast("double"),
        "before_bucket": bucket(F.col("word_before")), "after_bucket": bucket(F.col("word_after")),
        "before": says("word_before"), "before_that": says("word_before_that"), "after": says("word_after"),
    })
    made = made.join(_coverage(found), "value", "left")
    return made.withColumn("coverage", F.coalesce("coverage", F.lit(0.0))).drop("classes")


def known_formats(found: DataFrame) -> DataFrame:
    """Labelled findings from well-known formats among candidates: key, word_no, part, label.

    1 for cloud key ids and for random values assigned to a credential's name; 0 for
    addresses, hosts, card and telephone numbers, words without a mix of classes and plain
    words that nothing assigns.
    """
    value = F.col("value")
    assigned = F.col("name").rlike(CREDENTIAL) | (F.col("word_before").isin("=", ":") & F.col("word_before_that").rlike(CREDENTIAL))
    secret = value.rlike(f"^(?:{KNOWN})$") | (assigned & value.rlike("^[0-9A-Za-z+/_-]{16,}=*$"))
    plain = value.rlike(r"^[\w.%+-]+@[\w-]+(\.[\w-]+)+$|^[0-9.:()+ -]+$|^[^0-9@]+[0-9]{1,3}$")
    word = ~assigned & (F.col("assigned") == 0) & value.rlike(r"^\p{Lu}?[\p{Ll}\p{Lo}\p{M}]+$")
    label = F.when(secret, 1).when(plain | word, 0)
    return found.withColumn("label", label).filter("label IS NOT NULL").select("key", "word_no", "part", "label")


def _forest(rows: DataFrame, findings: DataFrame):
    """The fitted forest, or the only label there is (None without findings)."""
    parted = "part" in findings.columns  # without it a label is that of all parts of its word
    labels = findings.select(
        F.col("key").alias("k"), F.col("word_no").alias("n"), (F.col("part") if parted else F.lit(None).cast("long")).alias("p"),
        F.col("label").cast("double").alias("label"),
    ).dropDuplicates(["k", "n", "p"])
    same = F.col("key").eqNullSafe(F.col("k")) & (F.col("word_no") == F.col("n"))
    taught = rows.join(labels, same & (F.col("part") == F.col("p")) if parted else same)
    order = [F.xxhash64("key", "word_no", "value"), F.col("key"), F.col("word_no"), F.col("part"), F.col("value")]
    taught = stored(taught.orderBy(*order).limit(SAMPLE).select("label", *FEATURES))
    seen = sorted(r.label for r in taught.select("label").distinct().collect())
    if len(seen) < 2:
        return seen[0] if seen else None
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=SEED, featuresCol="features", labelCol="label", probabilityCol="forest_probability"
    )
    return forest.fit(VectorAssembler(inputCols=[*FEATURES], outputCol="features").transform(taught))


def judge(rows: DataFrame, findings: DataFrame) -> DataFrame:
    """The rows of `features` with the column `probability` of being a secret."""
    forest = _forest(rows, findings)
    if forest is None or isinstance(forest, float):
        return rows.withColumn("probability", F.lit(1.0 if forest is None else forest))
    made = forest.transform(VectorAssembler(inputCols=[*FEATURES], outputCol="features").transform(rows))
    made = made.withColumn("probability", vector_to_array("forest_probability")[1])
    return made.drop("features", "forest_probability", "rawPrediction", "prediction")


def scan(
    docs: DataFrame, findings: DataFrame | None = None, key: str = "doc_id", text: str = "text", path: str = "source",
    threshold: float = 0.5, learn: Column | None = None,
) -> DataFrame:
    """Kept findings: key, word_no, part, kind, length, value_sha256, probability.

    `findings` are labelled ones; without them, well-known formats among the candidates
    teach the forest, where `learn` (a condition on `key`) allows it.
    """
    rows = stored(features(stored(candidates(docs, key, text, path))))
    if findings is None:
        findings = known_formats(rows if learn is None else rows.filter(learn))
    judged = judge(rows, findings).filter(F.col("probability") >= threshold)
    kind = (
        F.when(F.col("value").rlike("^AKIA[0-9A-Z]{16}$"), "cloud key id")
        .when((F.col("named") == 1) | (F.col("before") == 1) | (F.col("before_that") == 1), "credential")
        .otherwise("random value")
    )
    return judged.select(
        F.col("key").alias(key), "word_no", "part", kind.alias("kind"), F.length("value").cast("long").alias("length"),
        F.sha2("value", 256).alias("value_sha256"), F.round("probability", 6).alias("probability"),
    )
