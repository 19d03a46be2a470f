"""Secret scans: candidates by shape, false positives removed by a random forest.

Words are cut at quotes, brackets and the other punctuation of code, JSON, addresses
and tables; every part that is long enough and mixes in digits, or has a run of
capitals, or is long or often changes between small letters and capitals, is a candidate, with the name that stands before it (``name=``, ``"name":``,
also in the words before), and so is every value given to a secret's name, of any
length and alphabet, and every phrase in quotes that is given to a password's name. The forest sees the length, the make-up and the changes between character
classes of the value, how much of it common syllables cover, the name, the words
around it and the path (source) of the document, never the formats below. It learns
from labelled findings, a table the caller may pass; without one, findings in one of
the published formats or a value given to a secret's name that is no plain word is
labelled 1, named values of letters only are left to the forest, all others are labelled 0. Everything is built from
column functions and the library's own forest, without Python in tasks.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from braidwork.llm.batches import free_name
from braidwork.session import materialize

# Bound of the fit.
SAMPLE_FINDINGS = 20_000
LEAST_CHARS = 10
# Shape of a value that is a candidate without a secret's name: digits, a run of capitals, 20 characters of
# the alphabets of keys, or three changes from small letters to capitals.
SHAPE = r"[0-9]|[A-Z]{16}|[A-Za-z+/_-]{20}|(?:[a-z]++[A-Z]++){3}"
MASK = "[SECRET]"
# Formats of published kinds of keys, used for labels only.
FORMATS = (
    r"^(AKIA|ASIA)[A-Z2-7]{16}$",
    r"^gh[pousr]_[A-Za-z0-9]{36,}$",
    r"^xox[abprs]-[A-Za-z0-9-]{10,}$",
    r"^sk_(live|test)_[A-Za-z0-9]{16,}$",
    r"^AIza[A-Za-z0-9_-]{35}$",
    r"^eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]*$",
)
NAMES = r"(?i)pass(word|wd|phrase)?$|pwd|secret|token|api_?key|auth|credential|private|access_?key|bearer"
# Values that are given to a secret's name in code and stand for none.
PLAIN = r"(?i)^(true|false|null|none|nil|undefined|str|string|int|bool|required|optional|yes|no|todo|x+|\*+|\.+|\$.*|%.*|<.*)$"
SYLLABLES = (
    "the|and|ing|tion|ent|ion|ter|est|ers|all|ver|her|that|ment|con|pro|com|per|str|out|one|our|ted|ness"
    "|sch|ein|ich|der|die|und|ung|gen|ver|lich|keit|que|les|des|ment|aux|elle|eur|ado|cion|ado|para|los|mente|user|name|mail|example|http|www"
)
FEATURES = (
    "n_chars", "digits", "capitals", "smalls", "others", "changes", "distinct_chars", "covered", "vowels", "hex",
    "named", "assigned", "quoted", "at_sign", "dots", "before_named", "before_assign", "before_word", "after_word",
    "path_code",
)
# A part of a word ends at blanks and at the punctuation of code, JSON, addresses and tables.
_ENDS = r"\s\"'`=:,;!?()\[\]{}<>|&\\"
_ASSIGN = r"(?:[:=]{1,3}+>?+|->)"
_CLOSED = r"[\\\"'`\])]*+"
_NAMED = NAMES.replace("(?i)", "").replace("(word", "(?:word").replace("$", f"(?![^{_ENDS}])")
# Groups: 1 the password of an address; 2 to 4 a secret's name and its value, in quotes or not; 5 and 6 any name and value.
_PART = (
    r"[A-Za-z][A-Za-z0-9+.-]*+://[^\s:/@\"']*+:([^\s@\"']++)@"
    rf"|(?=[^{_ENDS}]*?(?i:{_NAMED}))([^{_ENDS}]++){_CLOSED}{_ASSIGN}(?:\\*+[\"'`]([^\s\"'`]++)|([^\s\"'`&;,()\[\]{{}}<>|\\]++))"
    rf"|(?:([^{_ENDS}]++){_CLOSED}{_ASSIGN}[\\\"'`(\[{{]*+)?([^{_ENDS}]++(?:={{1,2}}+(?![^{_ENDS}]))?+)"
)
# A name at the end of a word, with and without the sign that gives it a value.
_GIVES = rf"([^{_ENDS}]+){_CLOSED}{_ASSIGN}[\\\"'`(\[{{]*$"
_LAST = rf"([^{_ENDS}]+){_CLOSED}$"
# A password's name and a whole value in quotes. Groups: 1 what stands before the value, 2 the name, 3 to 5 the value.
_PHRASE = (
    r"((?i:(pass(?:word|wd|phrase)?(?![A-Za-z])|pwd|secret))[A-Za-z0-9_]{0,40}+[\"'`\])]*+[\x20\x09]*+"
    rf"{_ASSIGN}[\x20\x09]*+[\"'`])(?:(?<=\")([^\"\r\n]++)\"|(?<=')([^'\r\n]++)'|(?<=`)([^`\r\n]++)`)"
)
_SIGN = rf"^{_ASSIGN}[\\\"'`(\[{{]*$"


def _share(value: Column, pattern: str) -> Column:
    return F.regexp_count(value, F.lit(pattern)) / F.char_length(value)


def _phrases(docs: DataFrame) -> DataFrame:
    """Values of several words in quotes: the columns of a candidate, with the place of the first word."""
    text = F.col("text").cast("string")
    each = docs.where(text.rlike(_PHRASE)).select(
        F.xxhash64("doc_id", text).alias("row"), "doc_id", F.coalesce("source", F.lit("")).alias("source"),
        text.alias("text"), F.explode(F.array_distinct(F.regexp_extract_all(text, F.lit(_PHRASE), F.lit(0)))).alias("word"),
    )
    group = lambda k: F.regexp_extract("word", _PHRASE, k)
    head = F.concat(F.expr("substring_index(text, word, 1)"), group(1))
    value = F.concat(group(3), group(4), group(5))
    found = each.select(
        "row", "doc_id", "source", (F.regexp_count(head, F.lit(r"[^\x20\x09-\x0D]+")) - 1).alias("place"), "word",
        F.lit("").alias("w2"), F.lit("").alias("w1"), F.lit("").alias("w3"), group(2).alias("name"), value.alias("value"),
        F.lit(True).alias("given"), F.lit(True).alias("shaped"),
    )
    return found.where(F.col("value").rlike(r"[^\x20\x09-\x0D][\x20\x09]+[^\x20\x09-\x0D]"))


def find_candidates(docs: DataFrame) -> DataFrame:
    """``row, doc_id, place, value`` and the features of every candidate of ``doc_id, text, source``."""
    text = F.col("text").cast("string")
    words = docs.where(text.isNotNull()).select(
        F.xxhash64("doc_id", text).alias("row"), "doc_id", "source", F.split(text, r"[\x20\x09-\x0D]+").alias("words")
    )
    loose = NAMES.replace("$", "")
    near = lambda i, k: F.coalesce(F.get("words", i + k), F.lit(""))
    signed = lambda w: w.contains("=") | w.contains(":") | w.contains(">")
    # Words that may hold a candidate: by shape, or with a secret's name or an address in or before them.
    placed = F.filter(
        F.transform("words", lambda w, i: F.struct(
            i.alias("place"), w.alias("word"), near(i, -2).alias("w2"), near(i, -1).alias("w1"), near(i, 1).alias("w3")
        )),
        lambda x: ((F.char_length(x["word"]) >= LEAST_CHARS) & x["word"].rlike(SHAPE))
        | (signed(x["word"]) & (x["word"].rlike(loose) | x["word"].rlike("://.*@")))
        | ((signed(x["w1"]) | x["word"].startswith("=") | x["word"].startswith(":")) & (x["w1"].rlike(loose) | x["w2"].rlike(loose))),
    )
    each = words.select("row", "doc_id", "source", F.explode(placed).alias("at")).select(
        "row", "doc_id", F.coalesce("source", F.lit("")).alias("source"), "at.*",
        F.posexplode(F.regexp_extract_all("at.word", F.lit(_PART), F.lit(0))).alias("nth", "part"),
    )
    group = lambda k: F.regexp_extract("part", _PART, k)
    before = F.when(F.col("w1").rlike(_SIGN), F.regexp_extract("w2", _LAST, 1)).when(
        F.col("word").rlike("^[=:]"), F.regexp_extract("w1", _LAST, 1)
    ).otherwise(F.regexp_extract("w1", _GIVES, 1))
    own = F.when(group(1) != "", F.lit("password")).otherwise(F.concat(group(2), group(5)))
    # The padding of base64 is kept; other punctuation at the end of a value without quotes is not its own.
    bare = F.regexp_replace(F.concat(group(4), group(6)), r"[.,;:!?#$%&*]+$", "")
    quoted = F.regexp_replace(F.concat(group(1), group(3)), r"\\+$", "")
    each = each.withColumn("name", F.when((own == "") & (F.col("nth") == 0), before).otherwise(own))
    each = each.withColumn("value", F.concat(quoted, bare))
    # "secret key: value" names its value two words before.
    further = (F.col("nth") == 0) & (own == "") & F.col("w1").rlike("[=:]$") & F.col("w2").rlike(NAMES)
    each = each.withColumn("given", (F.col("name").rlike(NAMES) & (F.col("name") != "")) | further)
    shaped = (F.char_length("value") >= LEAST_CHARS) & F.col("value").rlike(SHAPE)
    each = each.where((F.col("value") != "") & (shaped | F.col("given"))).withColumn("shaped", shaped)
    phrases = _phrases(docs)
    # The first word of a phrase is no finding of its own.
    first = phrases.select("row", "place", F.split("value", r"[\x20\x09]+")[0].alias("first"))
    same = (each["row"] == first["row"]) & (each["place"] == first["place"]) & first["first"].startswith(each["value"])
    each = each.join(first, same & ~each["shaped"], "left_anti").select(*phrases.columns).unionByName(phrases)
    v = F.col("value")
    changes = r"(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])|(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])"
    left = F.regexp_replace(F.lower("value"), SYLLABLES, "")
    flag = lambda condition: F.coalesce(condition, F.lit(False)).cast("double")
    return each.select(
        "row", "doc_id", "place", "value", "name", "w1", "w2", "shaped",
        F.char_length(v).cast("double").alias("n_chars"),
        _share(v, "[0-9]").alias("digits"), _share(v, "[A-Z]").alias("capitals"), _share(v, "[a-z]").alias("smalls"),
        _share(v, "[^A-Za-z0-9]").alias("others"),
        (F.regexp_count(v, F.lit(changes)) / F.char_length(v)).alias("changes"),
        (F.size(F.array_distinct(F.split(v, ""))) / F.char_length(v)).alias("distinct_chars"),
        (1 - F.char_length(left) / F.char_length(v)).alias("covered"),
        _share(v, "(?i)[aeiouy]").alias("vowels"),
        flag(v.rlike("^[0-9a-fA-F]+$") & v.rlike("[a-fA-F]")).alias("hex"),
        flag(F.col("given")).alias("named"), flag(F.col("name") != "").alias("assigned"),
        flag(F.col("word").rlike("[\"']")).alias("quoted"), flag(v.contains("@")).alias("at_sign"),
        F.regexp_count(v, F.lit(r"\.")).cast("double").alias("dots"),
        flag(F.col("w1").rlike(NAMES) | F.col("w2").rlike(NAMES)).alias("before_named"),
        flag(F.col("w1").rlike("^[=:]+$|[=:]$")).alias("before_assign"),
        flag(F.col("w1").rlike(r"^\p{L}+[.,]?$")).alias("before_word"),
        flag(F.col("w3").rlike(r"^\p{L}+[.,]?$")).alias("after_word"),
        (F.pmod(F.xxhash64("source"), F.lit(16))).cast("double").alias("path_code"),
    )


def format_label() -> Column:
    """1: a published format, or named with digits or signs among letters; null: named and unclear; else 0."""
    known = F.col("value").rlike("|".join(f"(?:{f})" for f in FORMATS))
    given = F.col("named") > 0
    plain = F.col("value").rlike(PLAIN) | ((F.col("covered") >= 0.9) & ~F.col("value").rlike("[0-9]"))
    mixed = F.col("value").rlike(r"^(?=.*[0-9])(?=.*[^0-9]).{6,}$|^(?=.*\p{L})(?=.*[^\p{L}.,/_-]).{6,}$|^[A-Za-z0-9+/_-]{20,}={0,2}$")
    return (
        F.when(known, 1.0).when(~given | plain, 0.0).when(mixed, 1.0).otherwise(F.lit(None).cast("double"))
    )


def train_forest(
    findings: DataFrame, labelled: DataFrame | None = None, *, sample: int = SAMPLE_FINDINGS, seed: int = 7,
) -> RandomForestClassificationModel | float:
    """Fit on at most ``sample`` labelled findings, half of them of label 1 if there are so many.

    ``labelled`` has ``row, place, label``, and ``value`` where a word has several findings; a null label is not used. With one label
    only, its smoothed share is returned instead of a forest.
    """
    if labelled is None:
        known = findings.withColumn("label", format_label())
    else:
        keys = ["row", "place", *(["value"] if "value" in labelled.columns else [])]
        known = findings.join(labelled.select(*keys, F.col("label").cast("double").alias("label")), keys)
    known = known.where(F.col("label").isNotNull()).select("row", "place", "value", "label", *FEATURES)
    parts = [
        known.where(F.col("label") == label).orderBy(F.xxhash64("row", "place"), "row", "place", "value").limit(sample // 2)
        for label in (0.0, 1.0)
    ]
    rows = materialize(parts[0].union(parts[1]), "findings")
    n, n1 = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).collect()[0]
    if n1 in (0, n):
        return (n1 + 0.5) / (n + 1.0)
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
    forest = RandomForestClassifier(numTrees=30, maxDepth=7, seed=seed, labelCol="label", featuresCol="features")
    return forest.fit(vectors)


def judge(findings: DataFrame, model: RandomForestClassificationModel | float, threshold: float = 0.5) -> DataFrame:
    """``row, doc_id, place, value, shaped, score, secret`` of all findings; ``shaped``: a secret by shape, not only by name."""
    if isinstance(model, float):
        scored = findings.withColumn("score", F.lit(model))
    else:
        vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(findings)
        scored = model.transform(vectors).withColumn("score", vector_to_array("probability")[1])
    return scored.select("row", "doc_id", "place", "value", "shaped", "score", (F.col("score") >= threshold).cast("int").alias("secret"))


def scan_secrets(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """All candidates of ``doc_id, text, source`` with the forest's ``score`` and ``secret`` (1: kept finding).

    ``place`` is the number of the word in its text, from 0. Null and empty texts
    have no candidates; a word has a candidate for each of its parts at most.
    Repeated rows give repeated findings. A null source is the empty path. An empty
    table gives no rows. Extra columns are ignored.
    """
    findings = materialize(find_candidates(docs), "findings")
    return judge(findings, train_forest(findings, labelled))


def redact(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` with every kept finding of ``found`` replaced by a mask.

    A value with the shape of a secret goes in all its places in the text, one that only its name gives
    away (it may be a common word) as a whole in the word it was found in. ``found`` is ``scan_secrets(docs)``.
    Other columns and texts without a secret stay as they are.
    """
    item = F.struct((-F.char_length("value")).alias("n"), "value", F.when(~F.col("shaped"), F.col("place")).alias("place"))
    at, values = free_name(docs, "_row"), free_name(docs, "_values")
    secrets = found.where("secret = 1").groupBy(F.col("row").alias(at)).agg(F.sort_array(F.collect_set(item)).alias(values))
    row = F.xxhash64("doc_id", F.col("text").cast("string"))
    marked = docs.withColumn(at, row).join(secrets, at, "left")
    here = F.filter(values, lambda x: x["place"].isNotNull())
    # Words with the blanks behind them, numbered as the places are.
    words = F.split("text", r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")

    def whole(word: Column, x: Column) -> Column:
        value = F.regexp_replace(x["value"], r"([^A-Za-z0-9])", r"\\$1")
        return F.regexp_replace(word, F.concat(F.lit(r"(?<![\p{L}\p{N}])"), value, F.lit(r"(?![\p{L}\p{N}])")), F.lit(MASK.replace("$", r"\$")))

    masked = F.array_join(
        F.transform(words, lambda w, i: F.aggregate(F.filter(here, lambda x: x["place"] == i), w, whole)), ""
    )
    text = F.when(F.size(here) > 0, masked).otherwise(F.col("text"))
    everywhere = F.filter(values, lambda x: x["place"].isNull())
    clean = F.aggregate(everywhere, text, lambda t, x: F.replace(t, x["value"], F.lit(MASK)))
    text = F.when(F.col(values).isNull(), F.col("text")).otherwise(clean)
    return marked.withColumn("text", text).select(*docs.columns)
