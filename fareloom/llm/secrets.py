"""Secret scans: broad candidates, and a random forest that removes the false ones. DataFrame functions only.

A candidate is a run of ``MIN_LENGTH`` or more letters, digits and ``+/_-``, with up to two ``=`` behind it, inside a word of
the text; a word may have many, as in code and JSON without blanks, and in ``name=value`` the value is one. A run has a
digit, or else capitals behind small letters, is assigned to a name, or has a word of ``KEYWORDS`` ahead of it: plain
long words of a text are none. The forest sees its length, the shares of kinds of characters, how often neighbouring characters change
kind, how much of it the corpus's frequent words cover, the path of the document and the words around it. It is
trained on labelled findings, of which the bounded sample below is taken; everything else covers all rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import land

MIN_LENGTH = 12
#: About so many labelled findings are learnt from, half of each label; beyond it, those with the smallest hashes.
MAX_TRAINING_ROWS = 20_000
DICTIONARY_WORDS = 400
_RUN = "[A-Za-z0-9+/_-]{%d,}={0,2}" % MIN_LENGTH
_ASSIGNED = "[=:]['\"` ]*$"
# Words that name secrets, and words of paths that hold made-up ones.
KEYWORDS = ["apikey", "auth", "bearer", "credential", "key", "passphrase", "passwd", "password", "private", "pwd", "secret", "token"]
SAMPLE_PATHS = ["demo", "doc", "example", "fixture", "mock", "sample", "spec", "test"]
# Public forms of keys, names a secret is assigned to, and names of harmless digests and numbers.
KEY_FORMS = ["AKIA[0-9A-Z]{16}", "AIza[0-9A-Za-z_-]{35}", "gh[pousr]_[0-9A-Za-z]{36}", "xox[abp]-[0-9A-Za-z-]{20,}", "[sr]k_live_[0-9A-Za-z]{20,}"]
SECRET_NAMES = "api_?key|access_?key|secret|token|passwd|password|passphrase|credential|private_?key|bearer"
HARMLESS_NAMES = "build|commit|checksum|digest|etag|hash|id|md5|revision|sha-?[0-9]*|uuid|version"
FEATURES = ["length", "digits", "capitals", "hex", "signs", "changes", "distinct", "covered", "quoted", "assigned",
            "named", "word_before", "path_depth", "path_sample"]


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None) -> DataFrame:
    """(doc_id, path, word, part, finding, before, prefix, after, quoted): candidates with the number of their word and
    their number among the runs of that word, from 0. ``before``: up to three words before, for the first run of a word
    only; ``prefix``: the text of the same word ahead of the run, from the end of the run before the last one on, in small
    letters; ``after``: one word after, for the last run only. So a word of many runs costs as much as its length."""
    path = F.col(path_col).cast("string") if path_col else F.lit(None).cast("string")
    words = docs.select(F.col(id_col).alias("doc_id"), path.alias("path"), F.split(text_col, r"\s+").alias("words"))
    long = F.expr(f"""filter(transform(words, (x, i) -> if(length(x) >= {MIN_LENGTH}, struct(i as word, x as whole,
        lower(array_join(slice(words, greatest(i - 2, 1), least(i, 3)), ' ')) as ahead,
        lower(coalesce(get(words, i + 1), '')) as behind), null)), h -> h is not null)""")
    runs = (words.select("doc_id", "path", F.inline(long))
            .select("doc_id", "path", "word", "ahead", "behind", F.expr(f"regexp_extract_all(whole, '{_RUN}', 0)").alias("runs"),
                    F.split("whole", _RUN, -1).alias("gaps")))
    parts = F.expr("""transform(runs, (x, k) -> struct(k as part, x as finding, if(k = 0, ahead, '') as before,
        lower(concat(coalesce(get(gaps, k - 1), ''), coalesce(get(runs, k - 1), ''), gaps[k])) as prefix,
        if(k = size(runs) - 1, behind, '') as after, concat(gaps[k], gaps[k + 1]) rlike '["\\'`]' as quoted))""")
    around = F.concat_ws(" ", "before", "prefix")
    plain = F.col("finding").rlike("[A-Za-z]") & (
        F.col("finding").rlike("[a-z][A-Z]") | F.rtrim(around).rlike(_ASSIGNED)
        | reduce(lambda a, b: a | b, [around.contains(k) for k in KEYWORDS]))
    return (runs.select("doc_id", "path", "word", F.inline(parts))
            .where(F.col("finding").rlike("[0-9]") | plain))


def dictionary(docs: DataFrame, text_col: str = "text", words: int = DICTIONARY_WORDS) -> DataFrame:
    """The most frequent words of four to ten small letters in all texts: one row with the array ``dictionary``."""
    counted = (docs.select(F.explode(F.split(F.lower(text_col), "[^a-z]+")).alias("w"))
               .where(F.length("w").between(4, 10)).groupBy("w").count())
    top = counted.orderBy(F.desc("count"), "w").limit(words)
    return top.agg(F.expr("transform(array_sort(collect_list(struct(-length(w), w))), x -> x.w)").alias("dictionary"))


def with_features(found: DataFrame, words: list[str]) -> DataFrame:
    """The columns of ``FEATURES``, none of them null."""
    text, length = F.col("finding"), F.length("finding")

    def share(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)) / length
    listed = F.array(*map(F.lit, words)) if words else F.expr("cast(array() as array<string>)")
    rest = F.aggregate(listed, F.lower(text), lambda left, w: F.replace(left, w, F.lit("")))
    around = F.concat_ws(" ", "before", "prefix")
    folders = F.coalesce(F.lower("path"), F.lit(""))
    named = reduce(lambda a, b: a | b, [around.contains(k) for k in KEYWORDS])
    sample = reduce(lambda a, b: a | b, [folders.contains(k) for k in SAMPLE_PATHS])
    values = {
        "length": length, "digits": share("[0-9]"), "capitals": share("[A-Z]"), "hex": share("[0-9a-fA-F]"),
        "signs": share("[^A-Za-z0-9]"),
        "changes": F.regexp_count(text, F.lit("(?<=[A-Za-z])(?=[^A-Za-z])|(?<=[0-9])(?=[^0-9])|(?<=[^A-Za-z0-9])(?=[A-Za-z0-9])")) / length,
        "distinct": F.size(F.array_distinct(F.split(text, ""))) / length,
        "covered": 1 - F.length(rest) / length, "quoted": F.col("quoted"),
        "assigned": F.rtrim(around).rlike(_ASSIGNED), "named": named,
        "word_before": F.array_contains(listed, F.element_at(F.split("before", " "), -1)),
        "path_depth": F.length(folders) - F.length(F.replace(folders, F.lit("/"), F.lit(""))), "path_sample": sample}
    return found.withColumns({n: F.coalesce(values[n].cast("double"), F.lit(0.0)) for n in FEATURES})


def labels_by_form() -> Column:
    """Labels of candidates where no reviewed findings are at hand: 1, 0 or, for most forms, null.

    Secrets are runs in a public form of a key, whatever stands around them, and runs assigned to the name of a secret, in
    the word before or in their own word (``token: x``, ``token=x``, ``"token":"x"``). Harmless are runs assigned to the
    name of a digest or number, and plain numbers and hexadecimal digits that no name of a secret precedes. No one
    feature tells the two apart: keys occur without a name, and harmless runs are assigned too.
    """
    around, ends = F.concat_ws(" ", "before", "prefix"), r"""["'` ]*[:=]["'` ]*$"""
    form = F.col("finding").rlike("^(?:" + "|".join(KEY_FORMS) + ")$")
    secret = around.rlike(f"(?:{SECRET_NAMES}){ends}") & (F.length("finding") >= 16)
    harmless = around.rlike(rf"(?:^|[^a-z])(?:{HARMLESS_NAMES}){ends}")
    plain = F.col("finding").rlike("^(?:[0-9]+|[0-9a-f-]+)$") & ~around.rlike(SECRET_NAMES)
    return F.when(form, 1).when(harmless, 0).when(secret, 1).when(plain, 0)


def train(labelled: DataFrame, max_rows: int = MAX_TRAINING_ROWS, trees: int = 20, depth: int = 6,
          seed: int = 5) -> RandomForestClassificationModel | None:
    """A forest from rows with ``FEATURES`` and ``label`` (0 or 1; null is left out). Without rows of both labels
    there is nothing to learn: None."""
    rows = labelled.where("label in (0, 1)").select(*FEATURES, F.col("label").cast("double").alias("label"))
    counts = {int(r.label): r["count"] for r in rows.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    draw = F.pmod(F.xxhash64(*FEATURES, F.monotonically_increasing_id()), F.lit(1 << 40))
    part = F.when(F.col("label") == 1, min(1.0, max_rows / 2 / counts[1])).otherwise(min(1.0, max_rows / 2 / counts[0]))
    chosen, _ = land(rows.where(draw < part * (1 << 40)), "findings")
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed).fit(
        VectorAssembler(inputCols=FEATURES, outputCol="features").transform(chosen))


def find_secrets(docs: DataFrame, labels, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None,
                 threshold: float = 0.5, **training) -> DataFrame:
    """One row per candidate: ``doc_id``, ``word`` (number of its word, from 0), ``part`` (number among the runs of that
    word, from 0), ``finding``, ``score`` (probability of a secret) and ``secret`` (whether it stays a finding).

    ``labels``: a frame of labelled findings (``doc_id``, ``word``, ``part``, ``label``; without ``part`` they are those of
    part 0) or a condition over the columns of ``candidates`` that gives the label. Repeated labels of a finding count as their largest, null ones not at all.
    With labels of one kind only, nothing is removed: every candidate has score 1. Null and empty texts have no
    candidate; long texts are scanned whole; a word gives all its candidates; repeated rows are reported as often as
    they occur; null ids and paths are allowed; other columns are not read. Empty tables give an empty result.
    """
    words = dictionary(docs, text_col).first().dictionary or []
    found, _ = land(candidates(docs, id_col, text_col, path_col), "candidates")
    described = with_features(found, words)
    if isinstance(labels, Column):
        labelled = described.withColumn("label", labels.cast("int"))
    else:
        part = F.col("part") if "part" in labels.columns else F.lit(0).alias("part")
        known = labels.groupBy("doc_id", "word", part).agg(F.max("label").alias("label"))
        labelled = described.join(known, ["doc_id", "word", "part"])
    model = train(labelled, **training)
    if model is None:
        scored = described.withColumn("score", F.lit(1.0))
    else:
        scored = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(described))
        scored = scored.withColumn("score", vector_to_array("probability")[1])
    return scored.select("doc_id", "word", "part", "finding", "score", (F.col("score") >= threshold).alias("secret"))
