"""Secret scan: candidate strings by pattern, false positives removed by a random forest.

Only DataFrame functions on the scan. Candidates are long runs of key characters, keys of known
families also behind a path, and whatever is assigned to a guilty word. Texts without a candidate
never leave their row; candidates of the others become rows of numbers (length, character
transitions, dictionary coverage, path marks, neighbouring words), are judged by a forest trained
on labelled findings, and the values found guilty are replaced in their texts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipsift.llm.common import text_of
from clipsift.session import durable
from clipsift.sources.modelstore import plain_model

MARK = "[SECRET]"
THRESHOLD = 0.5
FINDINGS = 6000  # made findings that the default forest learns from
KINDS_AT_ONCE = 8  # kinds of made findings that one plan spells

PLAIN = 8  # an assigned value from this length on is also replaced where it stands alone

# A run of 16 or more key characters and up to two padding marks; a key of a known family starts a
# run of its own, also behind a path.
FAMILY = r"(?:AKIA|ASIA|ghp_|gho_|ghs_|glpat-|sk-|sk_live_|pk_live_|rk_live_|xox[abprs]-|AIza|eyJ|SG\.|npm_|hf_)"
FAMILIES = f"^{FAMILY}"
_KEYS = "[A-Za-z0-9_+/.-]"
_START = f"(?<![A-Za-z0-9]){FAMILY}(?={_KEYS}{{12}})"
_TOKEN = f"(?<![A-Za-z0-9])eyJ(?:(?!(?!eyJ){_START}){_KEYS}){{12,}}+"  # its parts begin alike
CANDIDATE = (
    f"(?:{_TOKEN}|{_START}(?:(?!{_START}){_KEYS}){{12,}}+"
    f"|(?<!{_KEYS})(?=[_+/.-]*+[A-Za-z0-9])(?:(?!{_START}){_KEYS}){{16,}}+)={{0,2}}+"
)
LEAST_RUN = 15  # key characters in a row that a candidate has at least
SPACE = r"[\x20\x09-\x0D]+"

# Fixed word lists of the features.
GUILTY = r"(?i)pass(word|wd|phrase)?|secret|token|api[_-]?key|access[_-]?key|auth|credential|private|bearer|login"
# Whatever is assigned to a word with a guilty one in it: in quotes, or up to a space, a closing
# quote, a tag or the next assignment.
_HEAD = f"{GUILTY[:4]}(?:{GUILTY[4:]})" + r"[A-Za-z0-9_-]*+[\"'`\])]*+[\x20\x09-\x0D]*+[=:]{1,3}+(?!//)>?[\x20\x09-\x0D]*+"
_NEXT = r"[&;,][\"']?[A-Za-z0-9_.-]{1,40}[\"']?[=:]|[\"'`](?:[\x20\x09-\x0D,;:)\]}>]|$)|</"
ASSIGNED = _HEAD + (
    r"(?:\"(?:[^\"\\\n]|\\.)++\"|'(?:[^'\\\n]|\\.)++'|`[^`\n]++`"
    r"|[\"'`]?(?:(?!" + _NEXT + r")[^\x20\x09-\x0D])++)"
)
INNOCENT = (
    r"(?i)commit|sha[-_]?(1|256)?|md5|hash|checksum|digest|revision|version|build|uuid|guid|isbn|order|invoice"
    r"|tracking|card|phone|page|chapter|see|file|image|branch|example|placeholder|dummy"
)
DICTIONARY = (
    "access account admin alpha app article backup beta branch build cache client cloud code com config content copy"
    " data default demo design dev doc domain download draft dummy edit email error example export fake file final"
    " folder group guide home html http https image import index info install item json key lib light link list local"
    " login main manual map master menu message model module name network node note office online order page part"
    " password path photo placeholder plan plugin post print private product profile project public query release"
    " report sample script secret section server service session setup site source start state static style system"
    " table task team template test text theme time title token tool type update upload user value version video"
    " view web window world www year"
)
SYLLABLES = (
    "an en er ti on re in de la ver gen ment keit tion ing ou ai eau ba co di fo gu ha je ki lo mu ne po qui ra si ta va"
    " we ya zo schl ich cht th st"
)
COMMON = r"(?i)(?=th|he|in|er|an|re|on|at|en|nd|ti|es|or|te|of|ed|is|it|al|ar|st|to|nt|ng|se|ha|ou|le|de|ch|io|ei|ie|ve|me|co|la|ne|ge|un|be)"
PLACEHOLDER = r"(?i)^(<.*|\[.*|\$.*|\{.*|%.*|\*+|x+|\.+|-+|_+|null|none|nil|true|false|undefined|secret|your[_-].*)$"
REFERENCE = r"^[A-Za-z_$][A-Za-z0-9_]*+(\(|\[|::|->|\.[A-Za-z_])"

FEATURES = (
    "length", "digits", "uppers", "lowers", "marks", "turns", "case_turns", "vowels", "variety", "coverage", "slashes",
    "dots", "hyphens", "hexes", "plain_number", "uuid", "dated", "ending", "linked", "family", "guilty_word",
    "guilty_near", "innocent_near", "assigned", "quoted",
    "equals", "spaces", "pairs", "consonants", "plain_word", "placeholder", "reference",
)


def _share(value: Column, pattern: str) -> Column:
    """Share of the characters that a class of one character matches."""
    return F.regexp_count(value, F.lit(pattern)) / F.length(value)


def features(found: DataFrame) -> DataFrame:
    """Numbers of each candidate: columns value, word, before, earlier, after are given."""
    v, word = F.col("value"), F.coalesce("word", F.lit(""))
    before, earlier, after = (F.coalesce(c, F.lit("")) for c in ("before", "earlier", "after"))
    near = F.concat_ws(" ", earlier, before, word)
    uncovered = F.regexp_replace(F.lower(v), "|".join(sorted(DICTIONARY.split(), key=len, reverse=True)), "")

    def flag(condition: Column) -> Column:
        return condition.cast("double")

    made = {
        "length": F.length(v).cast("double"),
        "digits": _share(v, "[0-9]"),
        "uppers": _share(v, "[A-Z]"),
        "lowers": _share(v, "[a-z]"),
        "marks": _share(v, "[^A-Za-z0-9]"),
        "turns": _share(v, "(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])"),
        "case_turns": _share(v, "(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])"),
        "vowels": _share(v, "[aeiouAEIOU]"),
        "variety": F.size(F.array_distinct(F.split(v, ""))) / F.least(F.length(v), F.lit(40)),
        "coverage": 1 - F.length(uncovered) / F.length(v),
        "slashes": F.regexp_count(v, F.lit("/")).cast("double"),
        "dots": F.regexp_count(v, F.lit(r"\.")).cast("double"),
        "hyphens": F.regexp_count(v, F.lit("-")).cast("double"),
        "hexes": flag(F.rlike(v, F.lit("^([0-9a-f]+|[0-9A-F]+)$"))),
        "plain_number": flag(F.rlike(v, F.lit("^[0-9][0-9.-]*$"))),
        "uuid": flag(F.rlike(v, F.lit("(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"))),
        "dated": flag(F.rlike(v, F.lit("(19|20)[0-9]{2}[-/._]?(0[1-9]|1[0-2])"))),
        "ending": flag(F.rlike(v, F.lit(r"(?i)\.(html?|php|png|jpe?g|gif|pdf|js|css|txt|zip|gz|py|java|md|csv|xml|json)$"))),
        "linked": flag(F.rlike(word, F.lit("(?i)://|www[.]|@|^/|^[.]{1,2}/"))),
        "family": flag(F.rlike(v, F.lit(FAMILIES))),
        "guilty_word": flag(F.rlike(word, F.lit(GUILTY))),
        "guilty_near": flag(F.rlike(F.concat_ws(" ", earlier, before), F.lit(GUILTY))),
        "innocent_near": flag(F.rlike(near, F.lit(INNOCENT)) | F.rlike(after, F.lit(INNOCENT))),
        "assigned": flag(F.rlike(F.concat_ws(" ", before, word), F.lit("[=:]"))),
        "quoted": flag(F.rlike(word, F.lit("[\"'`]"))),
        "equals": flag(F.rlike(F.concat_ws(" ", before, word), F.lit("="))),
        "spaces": F.regexp_count(v, F.lit(SPACE)).cast("double"),
        "pairs": _share(v, COMMON),
        "consonants": F.coalesce(F.array_max(F.transform(
            F.regexp_extract_all(v, F.lit("(?i)[b-df-hj-np-tv-xz]+"), F.lit(0)), F.length)), F.lit(0)).cast("double"),
        "plain_word": flag(F.rlike(v, F.lit(r"^(\p{L}\p{Ll}*|\p{Lu}+)[.!?…]*$"))),
        "placeholder": flag(F.rlike(v, F.lit(PLACEHOLDER))),
        "reference": flag(F.rlike(v, F.lit(REFERENCE))),
    }
    return found.withColumns(made)


def made_findings(spark: SparkSession, n: int = FINDINGS) -> DataFrame:
    """Labelled findings of common families, spelled from hashes of a running number.

    Columns value, word, before, earlier, after, label. Real findings of the same shape can take
    their place in ``train``.
    """
    h, h2 = F.sha2(F.col("id").cast("string"), 256), F.sha2(F.concat(F.lit("b"), F.col("id").cast("string")), 256)
    b64 = F.regexp_replace(F.base64(F.unhex(F.concat(h, h2))), "[=\r\n]", "")
    words = F.array(*[F.lit(w) for w in DICTIONARY.split()])

    def pick(options: list[str], salt: str) -> Column:
        return F.array(*[F.lit(o) for o in options])[(F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(len(options)))).cast("int")]

    def name(salt: str) -> Column:
        return words[F.pmod(F.xxhash64("id", F.lit(salt)), F.size(words)).cast("int")]

    def number(low: int, high: int, salt: str) -> Column:
        return (low + F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(high - low + 1))).cast("int")

    def head(x: Column, n_: Column) -> Column:
        return F.substring(x, F.lit(1), n_)

    plain = pick(["the", "and", "of", "le", "der", "que", "with", "in", "was", "on"], "plain")
    sep = pick(["=", ":", " = ", ": ", " "], "sep")
    quote = pick(["", "", '"', "'"], "quote")
    key = pick(["password", "passwd", "token", "secret", "api_key", "API_KEY", "access_token", "auth", "client_secret", "bearer"], "key")
    told = pick(["commit", "sha256", "md5", "hash", "checksum", "revision", "uuid", "build", "digest", "sha1"], "told")
    digits = F.regexp_replace(F.conv(F.substring(h, 1, 15), 16, 10), "^0+", "1")
    upper = F.upper(F.regexp_replace(b64, "[+/a-z]", ""))
    camel = F.concat(name("c1"), F.initcap(name("c2")), F.initcap(name("c3")), number(1, 99, "c4").cast("string"))
    syllables = F.array(*[F.lit(x) for x in SYLLABLES.split()])

    def spoken(salt: str, least: int, most: int) -> Column:
        """A made word of so many syllables, now and then with a capital."""
        every = [syllables[F.pmod(F.xxhash64("id", F.lit(f"{salt}{i}")), F.size(syllables)).cast("int")] for i in range(most)]
        word = F.array_join(F.slice(F.array(*every), F.lit(1), number(least, most, f"{salt}n")), "")
        turn = number(0, 9, f"{salt}t")
        return F.when(turn < 6, word).when(turn < 9, F.initcap(word)).otherwise(F.upper(word))

    letters = F.regexp_replace(b64, "[^A-Za-z]", "")
    uuid = F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12))
    sign = pick(["!", "@", "#", "$", "%", "!!", "*", "&", "^"], "sign")
    join = pick(["-", "_", "."], "join")
    long_word = F.concat(spoken("l", 7, 10), F.lit("en"))
    path = F.concat_ws("/", name("p1"), name("p2"), number(1990, 2030, "p3").cast("string"), name("p4"))
    # (value, word key or before, near word, label)
    kinds = [
        (head(h, number(16, 40, "n1")), key, True, 1),
        (head(b64, number(20, 64, "n2")), key, True, 1),
        (F.concat(F.lit("AKIA"), head(F.concat(F.regexp_replace(upper, "[^A-Z2-7]", ""), F.lit("Q7ZK2M5XW3B6N4RT")), F.lit(16))), plain, False, 1),
        (F.concat(pick(["ghp_", "glpat-", "sk_live_", "xoxb-", "hf_", "AIza", "SG."], "fam"), head(F.regexp_replace(b64, "[+/]", "x"), number(24, 40, "n3"))), plain, False, 1),
        (F.concat(F.lit("eyJ"), head(F.regexp_replace(b64, "[+/]", "_"), number(30, 80, "n4"))), plain, False, 1),
        (head(F.regexp_replace(b64, "[+/]", "9"), number(24, 48, "n5")), key, True, 1),
        (head(h, number(32, 64, "n6")), told, True, 0),
        (head(h, number(16, 40, "n6b")), plain, False, 0),
        (uuid, plain, False, 0),
        (uuid, key, True, 1),
        (F.rpad(digits, 16, "7"), plain, False, 0),
        (F.rpad(digits, 16, "3"), pick(["card", "order", "phone", "invoice", "isbn"], "num"), True, 0),
        (F.concat(F.rpad(camel, 12, "x"), F.lit("Test42")), plain, False, 0),
        (F.concat(F.rpad(camel, 12, "x"), F.lit("example1")), key, True, 0),
        (F.concat(path, F.lit("/"), number(10, 9999, "n7").cast("string"), pick([".html", ".png", ".pdf", ".js", ""], "ext")), plain, False, 0),
        (F.concat(name("w1"), F.lit("-"), name("w2"), F.lit("-"), name("w3"), F.lit("-"), number(1, 2030, "n8").cast("string")), plain, False, 0),
        (F.concat(number(1990, 2030, "y").cast("string"), F.lit("-0"), number(1, 9, "m").cast("string"), F.lit("-1"), number(0, 9, "d").cast("string"), F.lit("T10.20.30")), plain, False, 0),
        (F.concat(F.lit("your_"), name("x1"), F.lit("_here_"), number(100, 999, "x2").cast("string")), key, True, 0),
        (F.concat(name("r1"), F.lit("-"), number(1, 20, "r2").cast("string"), F.lit("."), number(0, 99, "r3").cast("string"), F.lit("."), number(0, 99, "r4").cast("string"), F.lit("-release")), plain, False, 0),
        (head(letters, number(16, 40, "n9")), key, True, 1),
        (head(F.lower(letters), number(16, 40, "n10")), key, True, 1),
        (F.concat(pick(["AKIA", "ASIA"], "aws"), head(F.upper(letters), F.lit(16))), plain, False, 1),
        (F.concat(pick(["ghp_", "glpat-", "sk-", "sk_live_", "xoxp-", "hf_", "npm_"], "fam2"), head(letters, number(16, 40, "n11"))), plain, False, 1),
        (long_word, plain, False, 0),
        (long_word, key, True, 0),
        (F.concat(name("j1"), join, spoken("j", 2, 4), join, name("j2"), join, name("j3")), pick(["the", "token", "login", "in"], "j4"), True, 0),
        (F.concat_ws("/", name("k1"), spoken("k", 2, 4), name("k2"), spoken("kk", 2, 4)), plain, False, 0),
        (F.concat(name("m1"), F.initcap(name("m2")), F.initcap(name("m3")), F.initcap(name("m4"))), pick(["the", "token", "class", "in"], "m5"), True, 0),
        (F.concat(F.lit("www."), spoken("o", 2, 4), pick([".com", ".org", ".net/index", ".de/login"], "o2")), plain, False, 0),
        (F.concat(pick(["sk-", "npm_", "hf_"], "fam3"), name("q1"), pick(["-", "_"], "q2"), spoken("q", 3, 5), F.lit("_"), name("q3")), plain, False, 0),
    ]
    # (value, label) of what is assigned to a key and is no candidate by its length and characters
    given = [
        (F.concat(head(b64, number(4, 9, "g1")), sign, number(1, 99, "g2").cast("string")), 1),
        (F.concat(head(b64, number(8, 30, "g3")), sign, head(h, number(2, 20, "g4"))), 1),
        (F.concat(spoken("g5", 2, 3), number(1, 2030, "g6").cast("string"), sign), 1),
        (F.concat(name("g7"), sign, number(1, 2030, "g8").cast("string")), 1),
        (F.concat(spoken("g9", 2, 4), number(1, 9999, "g10").cast("string")), 1),
        (head(h, number(6, 15, "g11")), 1),
        (head(letters, number(6, 15, "g12")), 1),
        (head(F.lower(letters), number(8, 15, "g13")), 1),
        (F.concat_ws(" ", name("g14"), spoken("g15", 1, 3), name("g16"), spoken("g17", 1, 3)), 1),
        (spoken("g18", 1, 4), 0),
        (name("g19"), 0),
        (plain, 0),
        (number(0, 4096, "g20").cast("string"), 0),
        (pick(["<password>", "[hidden]", "***", "*****", "xxxx", "${SECRET}", "$TOKEN", "{{token}}", "%s", "null", "None", "true", "false", "...", "your_password", "[SECRET]"], "g21"), 0),
        (F.concat(name("g22"), pick(["_", "."], "g23"), name("g24"), pick(["()", "(self)", '["x"]', ".get"], "g25")), 0),
        (F.concat_ws(".", pick(["self", "os", "request", "config", "settings"], "g26"), spoken("g27", 1, 3), name("g28")), 0),
        (F.concat_ws(" ", *[spoken(f"g3{i}", 1, 4) for i in range(9)]), 0),
    ]
    assigned = F.col("kind") >= len(kinds)
    kinds += [(value, key, True, label) for value, label in given]
    around = F.when(F.col("value").contains(" "), pick(['"', "'"], "around")).otherwise(F.col("quote"))
    mixed = pick(["=", ":", " = ", ": ", "=", ": "], "mixed")

    def spelled_out(first: int) -> DataFrame:
        """Findings of a few kinds, written at once: one plan over all of them is too large for a driver."""
        own = list(enumerate(kinds))[first : first + KINDS_AT_ONCE]

        def by_kind(column: int) -> Column:
            values = [(i, k[column] if isinstance(k[column], Column) else F.lit(k[column])) for i, k in own]
            return reduce(lambda rest, x: F.when(F.col("kind") == x[0], x[1]).otherwise(rest), values, F.lit(None))

        rows = spark.range(0, n, 1, 2).withColumn("kind", F.col("id") % len(kinds)).filter(
            F.col("kind").between(first, first + len(own) - 1)
        )
        return durable(rows.select(
            "id", by_kind(0).alias("value"), by_kind(1).alias("near"), by_kind(2).cast("boolean").alias("named"),
            by_kind(3).cast("int").alias("label"), assigned.alias("given"),
        ), "findings")

    rows = reduce(DataFrame.unionByName, [spelled_out(i) for i in range(0, len(kinds), KINDS_AT_ONCE)])
    rows = rows.withColumns({"sep": sep, "quote": quote, "plain": plain})
    tight = F.col("named") & F.col("sep").isin("=", ":")
    spelled = F.concat("quote", "value", "quote")
    mark = F.trim("sep")
    none = F.lit(None).cast("string")
    return rows.select(
        "value",
        F.when(F.col("given"), F.concat("near", mixed, around, "value", around))
        .when(tight, F.concat("near", "sep", spelled)).otherwise(spelled).alias("word"),
        F.when(F.col("given"), none)
        .when(tight, F.col("plain")).when(F.col("named") & (mark != "") & F.col("sep").startswith(" "), mark)
        .when(F.col("named"), F.concat("near", mark)).otherwise(F.col("plain")).alias("before"),
        F.when(F.col("given"), none)
        .when(F.col("named") & ~tight & F.col("sep").startswith(" ") & (mark != ""), F.col("near")).otherwise(F.col("plain")).alias("earlier"),
        F.when(F.col("given"), none).otherwise(pick(["the", "is", "and", "en", "für", "in", "of"], "after")).alias("after"),
        F.col("label").cast("double").alias("label"),
    )


def train(findings: DataFrame, trees: int = 30, depth: int = 9, seed: int = 17) -> PipelineModel:
    """A random forest on labelled findings (label 1: a secret). The findings are a bounded table."""
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="_features")
    forest = RandomForestClassifier(
        featuresCol="_features", labelCol="label", probabilityCol="_p", rawPredictionCol="_raw", predictionCol="_says",
        numTrees=trees, maxDepth=depth, seed=seed, minInstancesPerNode=2,
    )
    spark = findings.sparkSession
    given = durable(findings.select("value", "word", "before", "earlier", "after", "label"), "findings")
    rows = durable(features(given).select(*FEATURES, "label").coalesce(2), "finding-features")
    return plain_model(Pipeline(stages=[assembler, forest]).fit(rows), spark)


def assigned_value(whole: Column) -> Column:
    """The value in a match of ASSIGNED, without quotes and closing marks."""
    rest = F.regexp_replace(whole, "^" + _HEAD, "")
    bare = F.regexp_replace(F.regexp_replace(rest, "^[\"'`]", ""), "[\"'`.,;]+$", "")
    unopened = ~F.rlike(bare, F.lit(r"[\[({<]"))
    bare = F.when(unopened, F.regexp_replace(bare, r"[\])}>]+[\"'`.,;]*$", "")).otherwise(bare)
    return F.when(F.rlike(rest, F.lit("(?s)^([\"'`]).+\\1$")), F.substring(rest, 2, F.length(rest) - 2)).otherwise(bare)


def candidates(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` (d, k, t) with a candidate, and these as an array ``found``.

    ``whole`` is the assignment of a value that no run of key characters equals, else null.
    """
    words = docs.filter(_suspicious()).withColumn("w", F.split("t", SPACE))
    none = F.lit(None).cast("string")
    runs = F.filter(
        F.transform("w", lambda w, i: F.struct(w.alias("word"), i.alias("at"))),
        lambda x: (F.length(x["word"]) >= LEAST_RUN) & F.rlike(x["word"], F.lit(CANDIDATE)),
    )
    runs = F.flatten(F.transform(runs, lambda x: F.transform(
        F.regexp_extract_all(x["word"], F.lit(CANDIDATE), F.lit(0)),
        lambda v, j: F.struct(
            x["at"].alias("at"), j.alias("part"), v.alias("value"), x["word"].alias("word"),
            F.get("w", x["at"] - 1).alias("before"), F.get("w", x["at"] - 2).alias("earlier"), F.get("w", x["at"] + 1).alias("after"),
            none.alias("whole"),
        ),
    )))
    given = F.transform(
        F.regexp_extract_all("t", F.lit(ASSIGNED), F.lit(0)),
        lambda m, j: F.struct(
            F.lit(-1).alias("at"), j.alias("part"), assigned_value(m).alias("value"), m.alias("word"),
            none.alias("before"), none.alias("earlier"), none.alias("after"), m.alias("whole"),
        ),
    )
    rows = words.withColumns({"runs": runs, "given": given})
    rows = rows.withColumn("known", F.transform("runs", lambda r: r["value"]))
    others = F.filter("given", lambda x: (x["value"] != "") & ~F.array_contains(F.col("known"), x["value"]))
    return rows.withColumn("found", F.concat("runs", others)).drop("w", "runs", "given", "known")


def _suspicious() -> Column:
    """Whether a text has a candidate; both patterns are tried only where a cheaper one lets them."""
    long_run = F.rlike("t", F.lit(f"{_KEYS}{{{LEAST_RUN}}}"))
    words = F.filter(F.split("t", SPACE), lambda w: F.length(w) >= LEAST_RUN)
    marked = F.contains(F.col("t"), F.lit("=")) | F.contains(F.col("t"), F.lit(":"))
    return (long_run & F.exists(words, lambda w: F.rlike(w, F.lit(CANDIDATE)))) | (marked & F.rlike("t", F.lit(ASSIGNED)))


def _replacements(mark: str) -> Column:
    """(old, new) of a guilty value: short ones are replaced only where they are assigned."""
    head = F.regexp_extract("whole", "^" + _HEAD, 0)
    rest = F.substring(F.col("whole"), F.length(head) + 1, F.length("whole"))
    alone = F.struct(F.col("value").alias("old"), F.lit(mark).alias("new"))
    there = F.struct(F.col("whole").alias("old"), F.concat(head, F.replace(rest, F.col("value"), F.lit(mark))).alias("new"))
    return F.when(F.col("whole").isNull(), F.array(alone)).when(F.length("value") >= PLAIN, F.array(there, alone)).otherwise(F.array(there))


def redact(docs: DataFrame, model: PipelineModel, threshold: float = THRESHOLD, mark: str = MARK) -> DataFrame:
    """Replace every secret in every whole text.

    Returns the columns of ``docs`` with ``text`` redacted (and ``n_chars``, if there, following
    it), and _candidates, _secrets, _values. A null text stays null; each row is scanned by
    itself, rows of one doc_id with different texts are told apart; an empty table gives no rows.
    """
    columns = docs.columns
    base = docs.select(F.struct(*columns).alias("row"), F.col("doc_id").cast("long").alias("d"), text_of(docs).alias("t"))
    base = base.select("row", F.coalesce("d", F.lit(-(2**63))).alias("d"), F.xxhash64("d", "t").alias("k"), "t")
    having = candidates(base)
    single = having.select("d", "k", F.explode("found").alias("f")).select("d", "k", "f.*")
    judged = model.transform(features(single)).withColumn("p", vector_to_array("_p")[1])
    guilty = judged.filter(F.col("p") >= threshold).groupBy("d", "k").agg(
        F.collect_set("value").alias("values"), F.countDistinct("at", "part").alias("n"),
        F.array_distinct(F.flatten(F.collect_set(_replacements(mark)))).alias("swaps"),
    )
    joined = having.join(guilty, ["d", "k"], "left")
    # Longer ones first, so that none is left as the tail of a shorter one.
    longest = F.array_sort(F.col("swaps"), lambda a, b: F.when(F.length(a["old"]) != F.length(b["old"]), F.length(b["old"]) - F.length(a["old"]))
                           .when(a["old"] < b["old"], -1).when(a["old"] > b["old"], 1).otherwise(0))
    untouched = F.col("n").isNull()
    text = F.aggregate(longest, F.col("t"), lambda acc, v: F.replace(acc, v["old"], v["new"]))
    changed = joined.withColumn("text", F.when(untouched, F.col("row.text")).otherwise(text)).select(
        *[F.col("text") if c == "text" else _follows(docs, untouched) if c == "n_chars" else F.col(f"row.{c}") for c in columns],
        F.size("found").cast("long").alias("_candidates"), F.coalesce("n", F.lit(0)).cast("long").alias("_secrets"),
        F.coalesce("values", F.array().cast("array<string>")).alias("_values"),
    )
    clean = base.filter(~_suspicious()).select(
        "row.*", F.lit(0).cast("long").alias("_candidates"), F.lit(0).cast("long").alias("_secrets"),
        F.array().cast("array<string>").alias("_values"),
    )
    return changed.unionByName(clean)


def _follows(docs: DataFrame, untouched: Column) -> Column:
    kind = docs.schema["n_chars"].dataType
    return F.when(untouched, F.col("row.n_chars")).otherwise(F.length("text").cast(kind)).alias("n_chars")
