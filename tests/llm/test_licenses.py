"""License scan against a plain reading of words and all alignments."""

import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from clipsift.llm import licenses as L
from tests.llm.conftest import DOC_SCHEMA, ODD_TEXTS

MIT, APACHE, GPL = L.TEMPLATES[3].text, L.TEMPLATES[5].text, L.TEMPLATES[8].text
LGPL = L.TEMPLATES[9].text


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def brute(text):
    w = words(text or "")
    places = []
    for label, phrase in (("mit", ["mit", "license"]), ("apache", ["apache", "license"]), ("gpl", ["general", "public", "license"])):
        places += [(i, label) for i in range(len(w)) if w[i : i + len(phrase)] == phrase]
    labels, best = {x for _, x in places}, 0.0
    for t in L.TEMPLATES:
        tw, key = words(t.text), words(t.key)
        at = next(i for i in range(len(tw)) if tw[i : i + len(key)] == key)
        hits = defaultdict(set)
        for i in range(len(w) - 2):
            for j in range(len(tw) - 2):
                if w[i : i + 3] == tw[j : j + 3]:
                    hits[i - j] |= {j, j + 1, j + 2}
        group, before = set(), None
        for d in [*sorted(hits), None]:
            if before is not None and (d is None or d - before > L.GAP):
                best = max(best, len(group) / len(tw))
                if 100 * len(group) >= L.COVER_PCT * len(tw) and set(range(at, at + len(key))) <= group:
                    labels.add(t.label)
                group = set()
            if d is not None:
                group |= hits[d]
                before = d
    return (
        len(w), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None),
        ",".join(sorted({x for _, x in places})), ",".join(sorted(labels)), max(best, 0.5 if places else 0.0),
    )


TEXTS = [
    "Released under the MIT License.", "mit-LICENSE mit license apache license", "General Public License general public license",
    "licensed under CC BY-NC 4.0", "Licensed under CC BY 4.0", "Licensed under CC BY-NC-SA 4.0",
    MIT, MIT.upper(), APACHE, GPL, LGPL, f"intro words {GPL} outro {MIT} end", "x " * 3000 + MIT + " y" * 3000,
    MIT.replace("copies of the Software", "copies of this fine new Software"), MIT.replace("deal in the Software without restriction,", ""),
    " ".join(MIT.split()[: len(MIT.split()) // 2]), "Licensed under the MIT License " * 50, "mit license" * 3, "mİt license Kmit license",
    "éapache license", "public license general", "the license", "a mit license b general public license c apache license",
    "This project is licensed under the MIT Licence", "Released under a new MIT License",
]


def scanned(df):
    rows = L.scan_licenses(df).drop("spans").collect()
    return sorted([(r[0], tuple(r)[1:]) for r in rows], key=str)


def test_equals_all_alignments(spark, make_docs, real_texts):
    texts = [*TEXTS, *ODD_TEXTS, *real_texts[:60]]
    docs = [(i, t) for i, t in enumerate(texts)]
    assert scanned(make_docs(docs)) == sorted([(i, brute(t)) for i, t in docs], key=str)


def test_spans(make_docs):
    rows = L.scan_licenses(make_docs([(1, f"one two {GPL} three {MIT}")])).collect()
    gpl, mit = len(words(GPL)), len(words(MIT))
    assert [(s["label"], s["first"], s["words"]) for s in rows[0]["spans"]] == [("gpl", 2, gpl), ("mit", 3 + gpl, mit)]


def test_repeated_null_and_clashing(spark, with_clashes):
    rows = [(None, "mit license"), (None, "apache license"), (7, "mit license"), (7, "mit license"), (7, None), (0, "mit license"), (None, None)]
    df = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], DOC_SCHEMA).repartition(3)
    want = sorted([(d, brute(t)) for d, t in rows], key=str)
    assert scanned(df) == want
    clashing = with_clashes(df).withColumns({c: F.lit(1) for c in ("w", "t", "g", "b", "k1", "k2", "template", "t_at", "row", "at")})
    assert scanned(clashing) == want


def test_empty_table(spark):
    assert scanned(spark.createDataFrame([], DOC_SCHEMA)) == []


def test_templates_are_checked(spark):
    with pytest.raises(ValueError):
        L.template_positions(spark, [L.Template("x", "not there", "some words that are long enough")])


def test_stays_in_the_jvm(make_docs):
    plan = L.scan_licenses(make_docs([(1, "mit license")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
