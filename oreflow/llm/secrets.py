"""Secret scan: candidates by form or by where they stand, and a random forest that removes false positives."""

from __future__ import annotations

import re

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

#: A run: at least 16 characters of a key's alphabet, with a digit, not a part of a longer run.
ALPHABET = r"A-Za-z0-9+/_\-"
RUN = rf"(?<![{ALPHABET}])(?=[A-Za-z+/_\-]*[0-9])[{ALPHABET}]{{16,}}(?![{ALPHABET}])"
# Fixed value: what ends a word here.
GAP = r"[\x20\x09-\x0D]+"
# Words that stand before secrets, and in assignments to them.
KEY_WORDS = "password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|auth|bearer|credential"
# Words that stand before identifiers and digests.
ID_WORDS = "commit|sha[0-9]*|md5|checksum|hash|digest|uuid|guid|id|version|build|order|card|number|phone|isbn|invoice|revision"
# A name with a key word in it, followed by a sign of assignment.  Each name is read once from its start,
# and only where the sign follows, so the time grows with the length of the text alone.
_NAME = r"A-Za-z0-9_\-"
_SIGN = r"""["'\]]?[\x20\t]*(?::=|=>|=|:(?!//))[\x20\t]*"""
_KEY = (
    rf"(?<![{_NAME}])(?=[{_NAME}]++[\"'\]]?[\x20\t]*[=:])(?=[{_NAME}]*?(?i:{KEY_WORDS}))[{_NAME}]++{_SIGN}"
    r"(?i:(?:bearer|basic|token)[\x20\t]+)?"
)
# What holds a secret whatever it is made of: the body of a private key, the password
# or the name alone before the host of a URL, a value assigned to a key word, a web token; and runs.
# The first that begins earliest counts, so no two candidates share a character.  Groups of each:
# what leads to the value, the value, what ends it.
FORMS = {
    "pem": (r"(-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----\s*(?:[A-Za-z-]+: [^\r\n]*\s+){0,8})([A-Za-z0-9+/=\s\\]*[A-Za-z0-9+/=\\])(\s*-----END)", "lve"),
    "url": (r"(://)(?:([^\s/@:]*:)([^\s/@]+)|([^\s/@:]+))(@)", "llvve"),
    "assigned": (rf"""({_KEY})(?:(")([^"\r\n]+)(")|(')([^'\r\n]+)(')|([^\s"',;]+))""", "llvelvev"),
    "jwt": (rf"(?<![{_NAME}])(eyJ[{_NAME}]{{5,}}+\.[{_NAME}]++\.[{_NAME}]*)", "v"),
    "": (f"({RUN})", "v"),
}
CANDIDATE = "|".join(pattern for pattern, _ in FORMS.values())
_ROLES = "".join(roles for _, roles in FORMS.values())
_GROUPS = {role: [i for i, r in enumerate(_ROLES, 1) if r == role] for role in "lve"}
#: Marks the place of a value in a copy of the text; a private-use character.
MARK = "\ue0f5"
# Fixed value: what stands for a secret that is given elsewhere.
PLACEHOLDER = r"^((?i:none|null|nil|undefined|true|false|string|str|required|optional)|[*.x]+|<[^>]*>|\$?\{.*\}|\$[A-Z_]+|%[A-Z_]+%)$"
# Openings that providers give to their keys, with what must follow.
PROVIDERS = (
    r"^(AKIA|ASIA)[0-9A-Z]{16}$",
    r"^gh[pousr]_[0-9A-Za-z]{36,}$",
    r"^xox[abprs]-[0-9A-Za-z\-]{10,}$",
    r"^sk_(live|test)_[0-9A-Za-z]{16,}$",
    r"^glpat-[0-9A-Za-z_\-]{20,}$",
)
# Words of code; with the commonest words of the texts they make the dictionary.
CODE_WORDS = (
    "access account action address admin api app array auth base block body build button call change char check child "
    "class click client code color config connect console content context control copy count create data date debug "
    "default delete demo dev device doc document domain element email error event example field file filter find "
    "folder font form format frame function get global group handler header hash height host html http https icon "
    "image index info init input insert int interface item json key label lang layout length level library license "
    "link list load local log main manager map master menu message meta method mobile mode model module name net "
    "node null number object option order org output package page param parent path photo php plugin point post "
    "prefix private process product project property public query read record ref release remove report request "
    "reset resource response result root row run sample save script search section select self send server service "
    "session set size sort source start state static status step stop store str string style sub submit system tab "
    "table tag target task template test text theme thread time title token tool tree type update upload uri url "
    "user util value var version video view web width window word work xml"
).split()
#: Words of the dictionary that come from the texts, at most, and letters that they have at least.
DICTIONARY_WORDS, LEAST_LETTERS = 2_000, 4

SCORE_NEEDED = 0.5
#: Labelled findings that the forest is fitted on, at most about this many; more are thinned by hash.
FIT_ROWS = 20_000
#: Findings that come with the module (``bundled``): how many of each template.
BUNDLED_EACH = 60
TREES, DEPTH = 30, 8

FEATURES = (
    "n_chars",
    "digit_share",
    "upper_share",
    "hex_share",
    "distinct_share",
    "class_changes",
    "vowel_changes",
    "repeats",
    "inner_gaps",
    "dictionary_share",
    "path_marks",
    "mail_mark",
    "assigned",
    "key_before",
    "key_inside",
    "id_before",
    "word_after",
)


def candidates(docs: DataFrame, keep: tuple[str, ...] = ("doc_id", "source")) -> DataFrame:
    """Every candidate in every whole text of ``docs`` (``text`` and the columns ``keep``).

    Candidates are runs of a key's alphabet, and whatever stands where a secret does (``FORMS``), of
    any length and with any marks.  ``nth`` counts them along the text; ``word`` is the word the value begins
    in, ``position`` that word's place, ``before`` the two words before it and ``after`` the next one; ``form``
    says where it stands (empty for a run), ``lead`` is what it follows there, ``shown`` all of the match.

    One pattern finds all in one pass, and a copy of the text with a mark at each value tells their
    places, so the time is in proportion to the text, however many there are.  Null and empty texts
    have none; a candidate that stands in a text twice comes twice, and so do those of repeated rows.
    """
    marked = "".join(f"${g}" for g in _GROUPS["l"]) + MARK + "".join(f"${g}" for g in _GROUPS["v"] + _GROUPS["e"])
    texts = docs.where(F.col("text").rlike(CANDIDATE)).select(
        *keep,
        F.split("text", GAP).alias("w"),
        F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("all"),
        F.split(F.regexp_replace(F.translate("text", MARK, "?"), CANDIDATE, marked), GAP).alias("marks"),
    )
    places = F.flatten(F.transform("marks", lambda x, i: F.array_repeat(i, F.regexp_count(x, F.lit(MARK)))))
    hits = texts.select(*keep, "w", F.posexplode(F.arrays_zip("all", places.alias("at"))).alias("nth", "hit"))
    shown, place = F.col("hit.all"), F.col("hit.at")
    part = lambda role: F.concat(*[F.regexp_extract(shown, CANDIDATE, g) for g in _GROUPS[role]])
    # The first group of a form is never empty in a match of it.
    form, first = F.lit(""), 1
    for name, (_, roles) in FORMS.items():
        if name:
            form = F.when(F.regexp_extract(shown, CANDIDATE, first) != "", name).otherwise(form)
        first += len(roles)
    return hits.select(
        *keep,
        "nth",
        place.alias("position"),
        F.get("w", place).alias("word"),
        F.concat_ws(" ", F.slice("w", F.greatest(place - 1, F.lit(1)), F.least(place, F.lit(2)))).alias("before"),
        F.concat_ws(" ", F.slice("w", place + 2, 1)).alias("after"),
        part("v").alias("candidate"),
        part("l").alias("lead"),
        form.alias("form"),
        shown.alias("shown"),
    )


def common_words(docs: DataFrame) -> list[str]:
    """The ``DICTIONARY_WORDS`` words of letters that stand in most texts of ``docs``, counted over all of them."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(rf"(?<!\pL)[a-z]{{{LEAST_LETTERS},16}}(?!\pL)"), F.lit(0)))
    counts = docs.select(F.explode(words).alias("word")).groupBy("word").count().where("count > 1")
    return [r.word for r in counts.orderBy(F.desc("count"), "word").limit(DICTIONARY_WORDS).collect()]


def any_of(words: list[str]) -> str:
    """A pattern for the longest of ``words`` (of letters) at a place, written as a tree of their letters."""
    tree: dict = {}
    for word in words:
        at = tree
        for letter in word:
            at = at.setdefault(letter, {})
        at[""] = {}

    def written(at: dict) -> str:
        ways = [letter + written(rest) for letter, rest in sorted(at.items()) if letter]
        if not ways:
            return ""
        return f"(?:{'|'.join(ways)}){'?' if '' in at else ''}"

    return written(tree) if tree else "(?!)"


def described(found: DataFrame, dictionary: str) -> DataFrame:
    """Candidates with the numbers that the forest decides on (``FEATURES``), all doubles.

    ``dictionary`` is a pattern for its words (``any_of``).
    """
    c, word = F.col("candidate"), F.col("word")
    n = F.length(c)
    count = lambda pattern, col=c: F.regexp_count(col, F.lit(pattern))
    flag = lambda cond: cond.cast("double")
    changes = [rf"{a}(?=[{ALPHABET}])(?!{a})" for a in ("[a-z]", "[A-Z]", "[0-9]")]
    covered = F.length(F.regexp_replace(F.lower(c), dictionary, ""))
    rest = F.regexp_replace(word, RUN, " ")
    # A value is described by where it stands, not by the marks that lead to it or are in it.
    form = F.col("form")
    within = lambda *forms: form.isin(*forms)
    values = {
        "n_chars": n,
        "digit_share": count("[0-9]") / n,
        "upper_share": count("[A-Z]") / n,
        "hex_share": count("[0-9a-f]") / n,
        "distinct_share": F.size(F.array_distinct(F.split(c, ""))) / F.least(n, F.lit(32)),
        "class_changes": sum((count(p) for p in changes), F.lit(0)) / n,
        "vowel_changes": count("(?i)[aeiou](?=[b-df-hj-np-tv-z])|[b-df-hj-np-tv-z](?=[aeiou])") / n,
        "repeats": count(r"(.)(?=\1)") / n,
        "inner_gaps": F.regexp_count(c, F.lit(GAP)),
        "dictionary_share": 1 - covered / n,
        "path_marks": F.when(form == "", count(r"[/.]", word) + flag(word.contains("://")) * 4).otherwise(0),
        "mail_mark": flag((form == "") & word.contains("@")),
        "assigned": flag(within("assigned", "url") | F.concat_ws(" ", "before", rest).rlike("[=:][\"']?\\s*$") | rest.rlike("[=:][\"']?\\s*$|=")),
        "key_before": flag(F.lower("before").rlike(rf"\b({KEY_WORDS})\b")),
        "key_inside": flag(within("assigned", "url") | F.lower(rest).rlike(rf"({KEY_WORDS})")),
        "id_before": flag(F.lower(F.concat_ws(" ", "before", rest)).rlike(rf"\b({ID_WORDS})\b")),
        "word_after": flag(F.col("after").rlike(r"^\p{L}+[,.]?$")),
    }
    return found.withColumns({k: v.cast("double") for k, v in values.items()})


def check_digit(digits: Column) -> Column:
    """Whether a number ends in its check digit, as those of payment cards do (doubling every second digit)."""
    at = F.filter(F.split(F.reverse(digits), ""), lambda x: x != "")
    value = lambda x, i: F.when(i % 2 == 0, x.cast("int")).otherwise(
        x.cast("int") * 2 - F.when(x.cast("int") > 4, 9).otherwise(0)
    )
    return F.aggregate(F.transform(at, value), F.lit(0), lambda a, x: a + x) % 10 == 0


def proven(found: DataFrame) -> DataFrame:
    """Candidates with the ``label`` that evidence outside the forest's features proves; null where there is none.

    Secret (1): a provider's own form of key, a web token whose head says so, the body of a private key.
    Not secret (0): a number with a right check digit, and a placeholder for a secret that is given elsewhere.
    """
    c = F.col("candidate")
    provider = F.col("form").isin("pem", "jwt") | c.rlike(r"^eyJ[A-Za-z0-9_\-]{5,}\.eyJ")
    for pattern in PROVIDERS:
        provider = provider | c.rlike(pattern)
    number = F.when(c.rlike("^[0-9]{13,19}$"), check_digit(c)).otherwise(False)
    return found.withColumn("label", F.when(c.rlike(PLACEHOLDER) | number, 0.0).when(provider, 1.0))


# Lines that labelled findings are made of.  {h}, {H}, {d}, {a}, {b}, {s} and {w} stand for
# random hex digits, capital ones, digits, letters with digits, base64, letters with marks, and words.
SECRET_LINES = (
    "password={h18} and then",
    "the password: {s12} was sent",
    "api_key={a32}",
    "export SECRET_ACCESS_KEY={b40}",
    "token = '{h40}'",
    'auth_token: "{a24}"',
    "set client_secret={a20} here",
    "use key {H20} for the service",
    "the token {a36} is old",
    "and {H20} or",
    "found {b44} in the log",
    "db://admin:{s10}@host.example/base",
    "https://{a24}@git.example/team/repo",
    "Authorization: Bearer {b48}",
    "passwd {h32} end",
    "secret={s9};",
    "pwd={w}{d3}!",
    "credentials = {b28}",
    'secret = "{w} {w} {w}"',
    'password: "{w} {w} {w} {w}"',
    "api_key={a3}.{a4}~{a5}",
    "-----BEGIN PRIVATE KEY-----\\n{b60}\\n{b52}\\n-----END PRIVATE KEY-----",
)
PLAIN_LINES = (
    "number {d16} was paid",
    "call {d10}{d6} now",
    "order {d18} shipped",
    "commit {h40} fixes it",
    "sha256 {h64} of the file",
    "checksum {h32} matches",
    "uuid {h8}-{h4}-{h4}-{h4}-{h12}",
    "mail to {w}.{w}{d12}@mail.example please",
    "see https://www.{w}.example/{w}/2024/{d2}/{w}-{w}-{w}-{d4}",
    "in /usr/lib/{w}/{w}_{w}/{w}{d2}/file",
    "call get_{w}_by_{w}_and_{w}_{d1} first",
    "class {w}{w}{w}Factory{d1} is",
    "max_{w}_{w}_size_{d3} is set",
    "password={w}",
    "password = get_{w}_from_{w}()",
    "token: {w}",
    "auth = {w}_{w}(config)",
    "secret: optional[{w}]",
    "api_key=your_api_key_here_{d3}",
    "token = tokens[{d1}]",
    "version {d1}.{d2}.{d4}-{w}-{d8}",
    "at 2024{d2}{d2}T{d6}Z_{w}_{w}",
    "build-{w}-{w}-{d12}",
    "img_{d8}_{d6}_{w}.jpg",
)


def bundled(spark, words: list[str], each: int = BUNDLED_EACH, seed: int = 1, lines: tuple[tuple[str, ...], ...] = (SECRET_LINES, PLAIN_LINES)) -> DataFrame:
    """Labelled findings that every forest learns from: candidates with ``label``, made from the lines above.

    ``each`` texts are made from each line by hashes of their number and ``seed``; ``words`` fill in words, and
    stand around the line, so that a text is not told by where it begins.
    """
    made = [(label, line) for label, group in zip((1.0, 0.0), lines, strict=True) for line in group]
    table = spark.createDataFrame(made, "label double, line string").coalesce(1).withColumn("k", F.monotonically_increasing_id())
    rows = spark.range(len(made) * each).withColumnRenamed("id", "doc_id").withColumn("k", F.col("doc_id") % len(made))
    holder = r"\{([a-zA-Z])([0-9]*)\}"
    known = F.split(F.lit(" ".join(words)), " ")

    def value(kind: Column, i: Column) -> Column:
        salt = lambda part: F.concat_ws("/", F.lit(seed), "doc_id", i, F.lit(part)).cast("binary")
        hexed = F.concat(F.sha2(salt(1), 256), F.sha2(salt(2), 256))
        coded = F.base64(F.unhex(hexed))
        letters = F.regexp_replace(coded, "[+/=\\s]", "")
        return (
            F.when(kind == "h", hexed)
            .when(kind == "H", F.regexp_replace(letters, "[a-z]", ""))
            .when(kind == "d", F.regexp_replace(hexed, "[a-f]", ""))
            .when(kind == "a", letters)
            .when(kind == "b", F.regexp_replace(coded, "\\s", ""))
            .when(kind == "s", F.translate(coded, "+/BCDQ9", "!#$%&*?"))
            .otherwise(F.get(known, F.pmod(F.xxhash64(salt(3)), F.lit(len(words))).cast("int")))
        )

    filled = rows.join(F.broadcast(table), "k").select(
        "doc_id",
        "label",
        F.split("line", holder, -1).alias("pieces"),
        F.transform(
            F.arrays_zip(
                F.regexp_extract_all("line", F.lit(holder), F.lit(1)).alias("kind"),
                F.regexp_extract_all("line", F.lit(holder), F.lit(2)).alias("size"),
            ),
            lambda x, i: F.when(x["size"] == "", value(x["kind"], i)).otherwise(
                F.left(value(x["kind"], i), F.try_to_number(x["size"], F.lit("999")).cast("int"))
            ),
        ).alias("values"),
    )
    line = F.array_join(F.zip_with("pieces", "values", lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    around = [value(F.lit("w"), F.lit(100 + i)) for i in range(3)]
    texts = filled.select("doc_id", "label", F.concat_ws(" ", *around[:2], line, around[2]).alias("text"))
    return candidates(texts, ("doc_id", "label")).select("doc_id", "nth", "position", "word", "before", "after", "candidate", "lead", "form", "shown", "label")


def fit_forest(labelled: DataFrame, n_rows: int, seed: int = 7) -> PipelineModel | None:
    """A forest from findings with ``label`` 0 or 1; None if one kind is missing.

    ``n_rows`` is the number of labelled findings; above ``FIT_ROWS`` they are thinned by a hash of the
    candidate.  Each kind weighs half.
    """
    part = min(1.0, FIT_ROWS / max(n_rows, 1))
    chosen = labelled.where(F.pmod(F.xxhash64("candidate", F.lit(seed)), F.lit(1 << 20)) < int(part * (1 << 20)) + 1)
    kinds = {r["label"]: r["count"] for r in chosen.groupBy("label").count().collect()}
    if not (kinds.get(0.0) and kinds.get(1.0)):
        return None
    weight = F.when(F.col("label") > 0, 1.0 / kinds[1.0]).otherwise(1.0 / kinds[0.0])
    rows = chosen.select(*FEATURES, "label", (weight * sum(kinds.values()) / 2).alias("weight"))
    # One order for every run, so that the trees' samples are the same.
    rows = rows.repartition(4, *FEATURES).sortWithinPartitions(*FEATURES)
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    forest = RandomForestClassifier(
        labelCol="label", weightCol="weight", numTrees=TREES, maxDepth=DEPTH, seed=seed, minInstancesPerNode=2
    )
    return PipelineModel([assembler, forest.fit(assembler.transform(rows))])


def scored(found: DataFrame, model: PipelineModel) -> DataFrame:
    """Adds ``score`` (0 to 1), the forest's, and ``secret``."""
    out = model.transform(found).withColumn("score", vector_to_array("probability")[1])
    out = out.drop("features", "rawPrediction", "probability", "prediction")
    return out.withColumn("secret", F.col("score") >= SCORE_NEEDED)


def scan(docs: DataFrame, work, findings: DataFrame | None = None, keep: tuple[str, ...] = ("doc_id", "source")) -> DataFrame:
    """All candidates of ``docs`` with ``score`` and ``secret``, whatever the forest makes of them.

    The forest learns from labelled findings: those that come with the module (``bundled``), those candidates of
    ``docs`` whose label is proven by evidence that is not among its features (``proven``), and your own
    (``findings``, with the columns of ``candidates`` and ``label``).  All other candidates have no label,
    and what it has learnt alone decides on them, in a small table as in a large one.  The words of its
    dictionary are counted over all texts.
    """
    spark = docs.sparkSession
    common = common_words(docs)
    dictionary = any_of(sorted({*CODE_WORDS, *common}))
    found = work.keep(proven(described(candidates(docs, keep), dictionary)), "candidates")
    columns = (*FEATURES, "candidate", "label")
    labelled = found.where("label is not null").select(*columns)
    given = bundled(spark, [*CODE_WORDS, *common[: len(CODE_WORDS)]])
    if findings is not None:
        given = given.unionByName(findings.select(*given.columns))
    labelled = work.keep(labelled.unionByName(described(given, dictionary).select(*columns)), "labelled")
    return scored(found, fit_forest(labelled, labelled.count()))


def redacted(docs: DataFrame, found: DataFrame, key: str, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every confirmed secret of a row replaced in its text.

    ``key`` tells the rows of ``docs`` apart and is among the columns that ``scan`` kept.  A run that is a secret
    at one place of a text is one at all its places there.  The text is put together anew from the pieces
    between its candidates, in one pass.  Other columns stay as they are; texts without a secret do not change.
    """
    run = F.when(F.col("candidate").rlike(f"^{RUN}$"), F.col("candidate")).otherwise(F.concat_ws(" ", F.lit("#"), "nth"))
    same = Window.partitionBy(key, run)
    told = found.select(key, "nth", F.max(F.col("secret")).over(same).alias("secret"))
    flags = told.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("nth", "secret"))).alias("_flags"), F.max("secret").alias("_any"))
    flags = flags.where("_any").select(F.col(key).alias("_key"), F.col("_flags.secret").alias("_flags"))
    hidden = "".join(f"${g}" for g in _GROUPS["l"]) + re.sub(r"([$\\])", r"\\\1", mark) + "".join(f"${g}" for g in _GROUPS["e"])
    matches = F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0))
    shown = F.zip_with(matches, "_flags", lambda m, secret: F.when(secret, F.regexp_replace(m, CANDIDATE, hidden)).otherwise(m))
    pieces = F.split("text", CANDIDATE, -1)
    clean: Column = F.array_join(F.zip_with(pieces, shown, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    joined = docs.join(flags, F.col(key) == F.col("_key"), "left")
    return joined.withColumn("text", F.when(F.col("_flags").isNull(), F.col("text")).otherwise(clean)).select(*docs.columns)
