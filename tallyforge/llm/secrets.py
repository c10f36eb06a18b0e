"""Secret scan: candidates by shape, false positives removed by a random forest. DataFrame operations and Spark ML only.

Candidates, found in any line of the whole text, are runs of at least 16 letters, digits and + / _ - with a digit in them, such runs
joined by dots, and whatever value follows a credential name and = or :, quoted or up to white space, of any length. The forest
sees its length, its kinds of characters and the transitions between them, how much of it dictionary words cover, whether it
stands in a path or address, and the words before and after it. It is trained on labelled findings; where a table has none,
``rule_labels`` labels the clear ones (known key formats and assignments to credential names against numbers, paths,
addresses and digests that are named as such) and leaves the others to the forest. At most ``max_labelled`` findings are
used for the fit, half of each label as far as there are, the first ones by a hash; every context of every finding of every text is scored.

Defined cases: null and empty texts have no candidates; a candidate that occurs several times in a document is scored in each
context and is one finding, with its most probable one (of equal ones the smallest); rows with the same id are one document; a null id is a document of its own; without labelled
findings of both kinds, the labels' only kind decides all (none: every candidate is kept); an empty table gives no rows;
other columns are ignored, or kept by ``redacted``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from .common import Scratch, new_name, shares

#: In front of a run there is no character of one; a digit follows within the run; then the run itself.
CHARACTER = "[A-Za-z0-9+/_-]"
START, RUN = rf"(?<!{CHARACTER})(?={CHARACTER}{{16}})(?=[A-Za-z+/_-]*+[0-9])", rf"{CHARACTER}{{16,}}+={{0,2}}"
#: Runs that dots join, as one.
DOTTED_START = rf"(?<!{CHARACTER})(?<!{CHARACTER}\.)(?=(?:\.?{CHARACTER}){{16}})(?=(?:\.?[A-Za-z+/_-])*+\.?[0-9])(?={CHARACTER}++\.{CHARACTER})"
DOTTED = rf"{CHARACTER}++(?:\.{CHARACTER}++)++={{0,2}}"
NAME = r"(?:passw(?:or)?d|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|credential|auth)[\"' ]{0,2}[=:]"
#: The value behind a credential name: to the closing quote (not behind a backslash), or else to white space.
VALUE_START = rf"(?i:{NAME}) {{0,3}}[\"']?"
VALUE = (r"(?:(?<=\")(?!\")[^\n]+?(?=(?<!\\)\")|(?<=')(?!')[^\n]+?(?=(?<!\\)')|[^\s\"']\S*+)")
#: Groups of up to 60 characters each before and after a match; 60 characters may have 120 code units, the first one is not halved.
BEFORE = r"(?<=((?![\uDC00-\uDFFF])(?:^[\s\S]{0,59}|[\s\S]{60,120})))"
AFTER = r"(?=([\s\S]{0,60}))"
#: Groups 1 to 3: before, candidate, after. A value is taken whole: names that stand in it start no values of their own.
PLACES = (f"{START}{BEFORE}({RUN}){AFTER}", f"{DOTTED_START}{BEFORE}({DOTTED}){AFTER}", f"{VALUE_START}{BEFORE}({VALUE}){AFTER}")
CANDIDATE = f"{START}|{DOTTED_START}|{VALUE_START}(?={VALUE})"
KNOWN = r"^(AKIA[0-9A-Z]{16}|ASIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}|eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+)$"
NAMED = r"(?i)(passw(or)?d|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|credential|auth)[\"' ]{0,2}[=:][ \"']{0,3}$"
DIGEST = r"(?i)(sha-?1|sha-?256|md5|commit|checksum|digest|etag|revision|uuid|isbn)\W{0,3}$"
#: Values that are clearly no secrets: names of types and nothing, references, calls.
PLAIN = r"(?i)^((true|false|null|none|nil|undefined|string|str|int|bool|boolean|object|any)[,;)\]}]*|[$<{%*].*|[\w.]+[(\[].*)$"
ADDRESS = r"(?i)(https?://\S*|www\.\S*|[\w.-]+/)$"
DICTIONARY = ("test example sample demo file path index user name data value image color page content version format number string "
              "http https html json true false null default public private client server about with from this that and the for are "
              "dans avec pour les des une est sur par nous vous mais der die das und ist nicht mit von auf ein eine auch sich "
              "los las del una con por para como pero que esta ser").split()
FEATURES = ["length", "digits", "uppers", "lowers", "marks", "to_digit", "from_digit", "case_changes", "kinds", "covered",
            "in_path", "named", "digest", "assigned", "quoted", "plain", "other", "words_before", "after_word"]


def findings(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, candidate, before, after (up to 60 characters of its line on both sides), n_lines; one row a different context.

    A line counts once for a candidate, with its smallest context, so that ``n_lines`` can be summed.
    """
    text = F.col(text_column).cast("string")
    lines = (documents.filter(text.rlike(CANDIDATE))
             .select(F.col(id_column).cast("long").alias("doc_id"), F.explode(F.split(text, "\n")).alias("line"))
             .filter(F.col("line").rlike(CANDIDATE)))
    part = lambda pattern, i: F.regexp_extract_all("line", F.lit(pattern), F.lit(i))
    zipped = [F.arrays_zip(part(p, 2).alias("candidate"), part(p, 1).alias("before"), part(p, 3).alias("after")) for p in PLACES]
    places = lines.select("doc_id", F.array_sort(F.array_distinct(F.concat(*zipped))).alias("places"))
    first = F.transform("places", lambda x, i: F.struct(
        x["candidate"].alias("candidate"), x["before"].alias("before"), x["after"].alias("after"),
        ((i == 0) | (F.get("places", i - 1)["candidate"] != x["candidate"])).cast("long").alias("lines")))
    return (places.select("doc_id", F.inline(first)).groupBy("doc_id", "candidate", "before", "after")
            .agg(F.sum("lines").alias("n_lines")))


def with_features(found: DataFrame) -> DataFrame:
    """The findings with the forest's features, all as doubles."""
    c, n = F.col("candidate"), F.length("candidate")
    count = lambda pattern: F.regexp_count(c, F.lit(pattern)) / n
    kind = {
        "length": n, "digits": count("[0-9]"), "uppers": count("[A-Z]"), "lowers": count("[a-z]"), "marks": count("[+/_=-]"),
        "to_digit": count("(?<=[A-Za-z])(?=[0-9])"), "from_digit": count("(?<=[0-9])(?=[A-Za-z])"),
        "case_changes": count("(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])"),
        "kinds": F.size(F.array_distinct(F.split(c, ""))),
        "covered": 1 - F.length(F.regexp_replace(F.lower(c), "|".join(sorted(DICTIONARY, key=lambda w: (-len(w), w))), "")) / n,
        "in_path": F.col("before").rlike(ADDRESS) | c.rlike("/.*/"), "named": F.col("before").rlike(NAMED),
        "digest": F.col("before").rlike(DIGEST), "assigned": F.col("before").rlike(r"[=:]\W{0,3}$"),
        "quoted": F.col("before").rlike("[\"']$"), "plain": c.rlike(PLAIN), "other": count(r"[^A-Za-z0-9+/_=-]"),
        "words_before": F.regexp_count("before", F.lit(r"[^\W\d_]+")), "after_word": F.col("after").rlike(r"^\W{0,2}[^\W\d_]+"),
    }
    return found.withColumns({name: value.cast("double") for name, value in kind.items()})


def rule_labels(found: DataFrame) -> DataFrame:
    """``label`` of the findings that are clear: 1 a secret, 0 none, null unknown."""
    c, before = F.col("candidate"), F.col("before")
    named = before.rlike(NAMED)
    quoted = before.rlike("[\"']$")
    strong = c.rlike(CANDIDATE) | quoted | (c.rlike(r"(?=\D*\d)(?=.*[^\W\d_])^\S{6,}$"))
    none = ((~named & c.rlike("^[0-9=-]+$")) | (named & c.rlike(PLAIN)) | (before.rlike(ADDRESS) & ~c.rlike(KNOWN)) | before.rlike(DIGEST)
            | c.rlike("^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$") | (~named & c.rlike("^[A-Za-z]+[_-]?[0-9]{1,4}$")))
    return found.withColumn("label", F.when(none, 0).when(c.rlike(KNOWN) | (named & strong), 1).cast("int"))


def train(labelled: DataFrame, max_labelled: int = 20000, trees: int = 20, depth: int = 6, seed: int = 11) -> PipelineModel | float:
    """The forest, or the only label there is (1 if there is none). ``labelled`` has the features and ``label``.

    Labels share the sample evenly, as far as they have rows; weights make up for it.
    """
    rows = labelled.filter("label IS NOT NULL").withColumn("order", F.xxhash64("candidate", "doc_id", "before", "after"))
    totals = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}  # two at most
    if len(totals) < 2:
        return float(*totals) if totals else 1.0
    taken = shares(totals, max_labelled)
    weight = {y: totals[y] / sum(totals.values()) * sum(taken.values()) / taken[y] for y in totals}
    sample = reduce(DataFrame.union, [
        rows.filter(F.col("label") == y).select("label", F.lit(weight[y]).alias("weight"), "order", *FEATURES)
        .orderBy("order", *FEATURES).limit(taken[y]) for y in sorted(totals)]).cache()
    try:
        shape = VectorAssembler(inputCols=FEATURES, outputCol="features")
        forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featuresCol="features", labelCol="label", weightCol="weight")
        return PipelineModel([shape, forest.fit(shape.transform(sample))])
    finally:
        sample.unpersist()


def scored(found: DataFrame, model: PipelineModel | float, keep_at: float = 0.5) -> DataFrame:
    """The findings with ``probability`` and ``is_secret``."""
    if isinstance(model, float):
        rows = found.withColumn("p", F.lit(model))
    else:
        rows = model.transform(found).withColumn("p", F.element_at(vector_to_array("probability"), 2)).drop(
            "features", "rawPrediction", "probability", "prediction")
    return rows.withColumns({"probability": F.round("p", 6), "is_secret": F.col("p") >= keep_at}).drop("p", *FEATURES)


def scan(documents: DataFrame, labels: Column | None = None, id_column: str = "doc_id", text_column: str = "text",
         max_labelled: int = 20000) -> DataFrame:
    """doc_id, candidate, before, after, n_lines, probability, is_secret; one row a candidate of a document.

    Every context is scored; the most probable one decides, and is the one that is shown.

    ``labels`` is a column over the findings (1, 0 or null); without it the clear findings are labelled by rule.
    """
    # written, as labels are counted, sampled and scored apart
    found = with_features(Scratch(documents.sparkSession, "secret-scan").keep(findings(documents, id_column, text_column), "contexts"))
    labelled = rule_labels(found) if labels is None else found.withColumn("label", labels.cast("int"))
    rows = scored(found, train(labelled, max_labelled))
    best = F.min(F.struct((-F.col("probability")).alias("p"), "before", "after", (~F.col("is_secret")).alias("no")))
    return (rows.groupBy("doc_id", "candidate").agg(best.alias("best"), F.sum("n_lines").alias("n_lines"))
            .select("doc_id", "candidate", "best.before", "best.after", "n_lines", (-F.col("best.p")).alias("probability"),
                    (~F.col("best.no")).alias("is_secret")))


def redacted(documents: DataFrame, secrets: DataFrame, id_column: str = "doc_id", text_column: str = "text",
             mark: str = "<secret>") -> DataFrame:
    """All rows, with the secrets of ``secrets`` (of ``scan``) replaced in their documents' texts, longest first."""
    key, listed = new_name("key"), new_name("listed")
    per_doc = (secrets.filter("is_secret").groupBy(F.col("doc_id").alias(key))
               .agg(F.sort_array(F.collect_set(F.struct(F.length("candidate").alias("n"), "candidate")), asc=False).alias(listed)))
    # all at once, so that no mark is searched again; a short value must stand alone
    literal = lambda c: F.concat(F.lit(r"\Q"), F.replace(c, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
    alone = lambda c: F.concat(F.lit(r"(?<![\p{L}\p{N}])"), literal(c), F.lit(r"(?![\p{L}\p{N}])"))
    pattern = F.array_join(F.transform(listed, lambda x: F.when(x["n"] < 16, alone(x["candidate"])).otherwise(literal(x["candidate"]))), "|")
    text, put = F.col(f"`{text_column}`").cast("string"), mark.replace("\\", "\\\\").replace("$", "\\$")
    replaced = F.when(F.col(listed).isNull(), text).otherwise(F.regexp_replace(text, pattern, F.lit(put)))
    joined = documents.join(per_doc, documents[f"`{id_column}`"].cast("long").eqNullSafe(F.col(key)), "left")
    return joined.withColumn(text_column, replaced).select(*[F.col(f"`{c}`") for c in documents.columns])
