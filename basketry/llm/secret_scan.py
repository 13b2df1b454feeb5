"""Secret scans: candidates by pattern, false positives removed by a random forest.

1. One pass counts the corpus' short words; the commonest make the dictionary (a bounded list).
2. Every long run of key characters in a word is a candidate, with what names it: the text
   before it in its part of the word, or the words before where that part assigns nothing.
3. A candidate becomes figures: its length, transitions between kinds of characters, variety,
   the share of it that dictionary words cover, marks in its path, and what its neighbours say.
4. A random forest, trained on at most ``TRAIN_FINDINGS`` labelled findings drawn by a hash,
   gives every candidate the probability of being a secret.

DataFrame functions and Spark's own forest only. Without labelled findings of your own, use
``label_by_assignment``: a value assigned to a name that says secret is one, and a value whose
neighbours assign nothing is none.

Defined results. A null or empty text has no findings. Without findings of both labels, every
candidate's score is the one label seen, or 0. Rows that repeat a doc_id are scanned one by one.
An empty table gives an empty result. Extra columns are not read.
"""

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.words import lower_ascii
from basketry.session import materialize

MIN_LENGTH = 16
TRAIN_FINDINGS = 20_000
TREES, DEPTH, SEED = 24, 6, 7
DICTIONARY_WORDS = 300
DICTIONARY_LENGTHS = (3, 7)
THRESHOLD = 0.5
# Runs of key characters; '=' only as the padding that completes groups of four at their end, so
# that a value begins after its assignment mark. The '//' of a url belongs to no value.
KEY = "[A-Za-z0-9+/_-]"
PADDED = rf"(?:{KEY}{{4}}){{{MIN_LENGTH // 4 - 1},}}(?:{KEY}{{2}}==|{KEY}{{3}}=)(?![A-Za-z0-9+/_=-]|[\"'\\]+{KEY})"
VALUE = rf"(?!(?<=:)//)(?:{PADDED}|{KEY}{{{MIN_LENGTH},}}+)"
# What ends a pair of name and value inside a word, and what assigns one to the other.
BETWEEN_PAIRS = r"[,;&?|<>(){}\[\]]"
ASSIGNS = r"=|:(?!/)"
# Names of things that are kept secret, and path parts that hold examples.
SECRET_NAME = r"(?i)(token|secret|passw|passwd|pwd|api.?key|access.?key|private.?key|credential|auth)"
EXAMPLE_PATH = r"(?i)(^|[/_.-])(test|tests|example|examples|sample|samples|doc|docs|fixture|fixtures)([/_.-]|$)"
FEATURES = ("length", "digits", "upper", "to_digit", "to_letter", "case_changes", "variety", "hex", "symbols",
            "covered", "example_path", "named", "assigned", "quoted")


def _values(part: Column, is_first: Column) -> Column:
    """The values of a part of a word that holds one pair at most, in order, as an array of
    (value, named, assigned, alone, quoted). ``alone`` values have only the words before the
    part to name them."""
    values, gaps = F.regexp_extract_all(part, F.lit(f"({VALUE})"), 1), F.split(part, VALUE)
    marks = F.transform(gaps, lambda gap: gap.rlike(ASSIGNS))
    # Whether the part's first name says secret, and which value is the first after its mark.
    secret = F.regexp_extract(part, f"(?s)^(.*?)(?:{ASSIGNS})", 1).rlike(SECRET_NAME)
    # Facts about the whole part are found once and stand beside each value.
    beside = lambda fact: F.array_repeat(fact, F.size(values))
    met = F.arrays_zip(
        values.alias("value"), gaps.alias("gap"), F.concat(F.array(F.lit("")), values).alias("last"),
        beside(secret).alias("secret"), beside(F.array_position(marks, F.lit(True))).alias("mark"),
        beside(part.rlike("[\"']")).alias("quoted"))
    return F.filter(F.transform(met, lambda m, i: F.when(m["value"].isNotNull(), F.struct(
        m["value"].alias("value"),
        # A name may be as long as a value: then it is the run before this one.
        (((m["mark"] > 0) & (m["mark"] <= i + 1) & m["secret"])
         | (m["gap"].rlike(ASSIGNS) & F.concat(m["last"], m["gap"]).rlike(SECRET_NAME))
         | ((m["mark"] == 0) & m["gap"].rlike(SECRET_NAME))).alias("named"),
        ((m["mark"] > 0) & (m["mark"] <= i + 1)).alias("assigned"),
        (is_first & ((m["mark"] == 0) | (m["mark"] > i + 1))).alias("alone"),
        m["quoted"].alias("quoted")))), lambda m: m.isNotNull())


def candidates(documents: DataFrame, path: Column) -> DataFrame:
    """(doc_id, place, part, path, value, named, assigned, quoted): one row per candidate, the
    ``part``-th of the word number ``place``."""
    words = F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), r"[\x20\x09-\x0D]+")
    near = lambda i, n: F.coalesce(F.get(F.col("words"), i + n), F.lit(""))
    found = F.filter(F.transform("words", lambda w, i: F.when(
        (F.length(w) >= MIN_LENGTH) & w.rlike(VALUE),
        F.struct(i.alias("place"), w.alias("word"),
                 F.concat_ws(" ", near(i, -2), near(i, -1)).rlike(SECRET_NAME).alias("named"),
                 near(i, -1).rlike("[=:]$").alias("assigned"))
    )), lambda c: c.isNotNull())
    rows = documents.select("doc_id", path.alias("path"), words.alias("words"))
    met = rows.select("doc_id", "path", F.explode(found).alias("c"))
    values = F.flatten(F.transform(F.split(F.col("c.word"), BETWEEN_PAIRS), lambda part, k: _values(part, k == 0)))
    # The word, which may be a whole file, does not go along with each of its values.
    return met.select("doc_id", "path", F.col("c.place").cast("long").alias("place"), F.col("c.named").alias("near_named"),
                      F.col("c.assigned").alias("near_assigned"), F.posexplode(values).alias("part", "v")).select(
        "doc_id", "place", "part", "path", "v.value",
        (F.col("v.named") | (F.col("v.alone") & F.col("near_named"))).alias("named"),
        (F.col("v.assigned") | (F.col("v.alone") & F.col("near_assigned"))).alias("assigned"), "v.quoted")


def dictionary(documents: DataFrame) -> list[str]:
    """The commonest words of three to seven small letters, counted over all documents."""
    low, high = DICTIONARY_LENGTHS
    words = documents.select(F.explode(F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), r"[^A-Za-z]+")).alias("w"))
    counts = words.where(F.length("w").between(low, high)).select(lower_ascii(F.col("w")).alias("w")).groupBy("w").count()
    return [r.w for r in counts.orderBy(F.desc("count"), "w").limit(DICTIONARY_WORDS).collect()]


def describe(found: DataFrame, words: list[str]) -> DataFrame:
    """The features of every candidate, as doubles."""
    value, length = F.col("value"), F.length("value")
    share = lambda pattern: F.regexp_count(value, F.lit(pattern)) / length
    # Longer words first, so that a word is not cut by a shorter one that begins it.
    known = "|".join(sorted(words, key=lambda w: (-len(w), w))) or "(?!)"
    left = F.length(F.regexp_replace(lower_ascii(value), known, ""))
    flag = lambda condition: F.coalesce(condition, F.lit(False)).cast("double")
    return found.withColumns({
        "length": length.cast("double"), "digits": share("[0-9]"), "upper": share("[A-Z]"),
        "to_digit": share("[A-Za-z](?=[0-9])"), "to_letter": share("[0-9](?=[A-Za-z])"),
        "case_changes": share("[a-z](?=[A-Z])|[A-Z](?=[a-z])"),
        "variety": F.size(F.array_distinct(F.split(value, ""))) / F.least(length, F.lit(64)),
        "hex": flag(value.rlike("^([0-9a-f]+|[0-9A-F]+)$")), "symbols": share("[+/_=-]"),
        "covered": 1 - left / length, "example_path": flag(F.col("path").rlike(EXAMPLE_PATH)),
        "named": flag(F.col("named")), "assigned": flag(F.col("assigned")), "quoted": flag(F.col("quoted")),
    })


def label_by_assignment(described: DataFrame) -> DataFrame:
    """Findings with a label: 1 for an assigned value whose name says secret, 0 for one that
    nothing assigns; other findings stay unlabelled and are left out."""
    return described.withColumn("label", F.when((F.col("named") == 1) & (F.col("assigned") == 1), 1.0)
                                .when(F.col("assigned") == 0, 0.0)).where(F.col("label").isNotNull())


def training_sample(findings: DataFrame, limit: int) -> DataFrame:
    """At most ``limit`` findings, half of each label where there are so many."""
    counts = {r.label: r["count"] for r in findings.groupBy("label").count().collect()}
    parts = 1 << 30
    share = {label: int(parts * min(1.0, 0.48 * limit / n)) for label, n in counts.items()}
    drawn = F.pmod(F.xxhash64("doc_id", "place", "value"), F.lit(parts))
    wanted = F.lit(False)
    for label, part in share.items():
        wanted = wanted | ((F.col("label") == label) & (drawn < part))
    return findings.where(wanted).limit(limit)


def score(described: DataFrame, findings: DataFrame, limit: int = TRAIN_FINDINGS) -> DataFrame:
    """``described`` with ``score``, from a forest that learns the labels of ``findings``."""
    sample = materialize(training_sample(findings, limit).select("label", *FEATURES), "secret-sample")
    labels = [r.label for r in sample.select("label").distinct().collect()]
    if len(labels) < 2:
        return described.withColumn("score", F.lit(float(labels[0]) if labels else 0.0))
    assemble = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, maxMemoryInMB=64)
    model = forest.fit(assemble.transform(sample).select("label", "features"))
    scored = model.transform(assemble.transform(described))
    return scored.withColumn("score", vector_to_array("probability")[1]).drop(
        "features", "rawPrediction", "probability", "prediction")


def scan(documents: DataFrame, path: Column, findings: DataFrame | None = None) -> DataFrame:
    """(doc_id, place, part, value_sha256, length, score, is_secret) of every candidate. ``place``
    is the number of the word and ``part`` that of the value in it; values leave only as hashes.
    ``findings`` are labelled rows with
    the columns of FEATURES, label, doc_id, place and value."""
    described = materialize(describe(candidates(documents, path), dictionary(documents)), "secret-candidates")
    scored = score(described, label_by_assignment(described) if findings is None else findings)
    return scored.select("doc_id", "place", "part", F.sha2(F.col("value").cast("binary"), 256).alias("value_sha256"),
                         F.col("length").cast("int").alias("length"), "score",
                         (F.col("score") >= THRESHOLD).alias("is_secret"))
