"""Phrases and templates against plain loops and the DuckDB SQL."""

import random
import re

import pytest

from kerbside.llm.licenses import PHRASES, TEMPLATES, block_words, needed_words, scan_licenses
from kerbside.llm.queries import ORACLES, QUERIES
from verification.compare import difference

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text, templates, threshold):
    words = WORD.findall((text or "").translate(ASCII_LOWER))
    found, starts = {}, []
    for phrase, label in PHRASES.items():
        parts = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
        starts += at
        if at:
            found[label] = 1.0
    base = ",".join(sorted(found))
    best = 0.0
    for label, template in templates:
        own = WORD.findall(template.translate(ASCII_LOWER))
        distinct = set(own)
        for i in range(len(words)):
            common = len(distinct & set(words[i : i + block_words(own)]))
            if common >= needed_words(len(distinct), threshold):
                found[label] = 1.0
                best = max(best, common / len(distinct))
    starts.sort()
    ends = (starts[0], starts[-1]) if starts else (None, None)
    return len(words), len(starts), *ends, base, ",".join(sorted(found)), 1.0 if starts else best


def texts(templates):
    random.seed(9)
    pool = sorted({w for _, t in templates for w in t.split()} | {"x", "é", "cc", "by"})
    made = [None, "", "...", "CC-BY cc by", "cc", "by", "GENERAL public\nlicense", "all rights all rights reserved", "x " * 3000]
    for _, template in templates:
        words = template.split()
        made += [f"Before {template.upper()}. After", " ".join(words[1:]), " ".join(reversed(words))]
        made.append(" x ".join(words))
    for _ in range(60):
        made.append(random.choice([" ", ", ", "\n"]).join(random.choice(pool) for _ in range(random.randrange(40))))
    return made + made[4:9]


OWN = [("odd", "a b c d a b"), ("Even", "b c"), ("odd", "É x y z"), ("one", "x")]


@pytest.mark.parametrize(("templates", "threshold"), [(TEMPLATES, 0.9), (TEMPLATES, 0.6), (OWN, 0.8), (OWN, 1.0), (OWN, 0.1)])
def test_as_plain_loops(spark, templates, threshold):
    rows = [(i if i % 7 else None, t, 1, "y") for i, t in enumerate(texts(templates))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, words int, labels string")
    expected = sorted(map(str, ((i, *plain(t, templates, threshold)) for i, t, _, _ in rows)))
    found = scan_licenses(docs, templates=templates, threshold=threshold).collect()
    assert sorted(str(tuple(r)) for r in found) == expected


def test_empty_table_and_no_templates(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert scan_licenses(docs).count() == 0
    with pytest.raises(ValueError):
        scan_licenses(docs, templates=[])


def test_no_python_in_the_plan(spark):
    plan = scan_licenses(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_query_equals_its_sql(spark):
    assert difference(spark, "/root/testdata/sf0.001", QUERIES["op10_license_scan"], ORACLES["op10_license_scan"]) is None
