"""Line-first rules against a plain Python count."""

import re
from collections import Counter

from clipsift.llm import quality
from clipsift.llm.queries import llm_queries
from tests.llm.conftest import ODD_TEXTS
from tests.oracle import compare, connect

PROSE = "The quick brown fox jumped over many lazy dogs near a calm river today."


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often, inside = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            inside.update(range(i, i + 5))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)), len(inside),
        len(words) < 10 or 100 * len(inside) > 20 * len(words),
    )


def test_counts(make_docs, with_clashes):
    texts = [*ODD_TEXTS, "a b c d e a b c d e", "x " * 300, "a b c d e f g h i j k\n" * 4, "one\n\none\n \n",
             "p q r s t u " * 2 + "v w x y z 1 2 3 4 5 6 7 8 9 10 11 12 13", PROSE * 3000]
    rows = [*enumerate(texts), (0, "again and again"), (None, PROSE)]
    out = quality.clean_lines(with_clashes(make_docs(rows))).collect()
    got = sorted(str((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)) for r in out)
    assert got == sorted(str((d, *brute(t))) for d, t in rows)


def test_verdicts(make_docs):
    junk_nav = "home | about us | news | jobs | contact | imprint | help"
    rows = [
        (0, f"{PROSE}\n{PROSE[:-1].upper()}.\nSome other calm words follow here, as they should, and then a few more."),
        (1, "\n".join([junk_nav] * 3)),
        (2, f"{PROSE}\n\nAll rights reserved.\nSome other calm words follow here, as they should."),
        (3, " ".join(w + "%%%" for w in PROSE.split())),
        (4, None),
    ]
    out = {r.doc_id: r for r in quality.clean_lines(make_docs(rows)).collect()}
    assert [out[i].kept for i in range(5)] == [True, False, True, False, False]
    assert out[0].n_lines_failed == 1 and "QUICK" not in out[0].clean_text
    assert out[2].clean_text == f"{PROSE}\n\nSome other calm words follow here, as they should."
    assert quality.clean_lines(make_docs([])).collect() == []


def test_no_python_and_no_shuffle(spark, sf_dir):
    plan = llm_queries()["op1_quality_rules"].plan(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_sql(spark, sf_dir):
    q = llm_queries()["op1_quality_rules"]
    assert compare(q.plan(spark, sf_dir), connect(sf_dir), q.sql) == []


def test_verdict_follows_labels(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = llm_queries()["op1_quality_rules"].plan(spark, sf_dir).join(labels, "doc_id").collect()
    clean = [r for r in rows if r.quality == 1 and not r.base_failed]
    junk = [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in clean) >= 0.98 * len(clean)
    assert sum(r.kept for r in junk) <= 0.05 * len(junk) + 1
