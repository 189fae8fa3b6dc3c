"""Licences of several paragraphs inside longer documents."""

import random

import duckdb
import pandas as pd
import pytest

from tenurelens.llm import licenses

from .helpers import awkward, prose, row, table


def broken(text, n):
    """A template as published: in n paragraphs, with lines and punctuation."""
    words = text.split()
    parts = [words[len(words) * i // n : len(words) * (i + 1) // n] for i in range(n)]
    return "\n\n".join("\n".join(" ".join(p[k : k + 12]) for k in range(0, len(p), 12)).capitalize() + "." for p in parts)


LONG = [(name, text) for name, text in licenses.TEMPLATES if len(text.split()) > 60]


def rows_of():
    draw = random.Random(3)
    out = []
    for i, (_, text) in enumerate(LONG):
        for n in (1, 3, 4):
            out.append(row(100 + 10 * i + n, f"{prose(i, 60)}\n\n{prose(i + 9, 30)}\n \n{broken(text, n)}\n\n***\n\n{prose(i + 50, 80)}"))
    words = "permission is hereby granted free of charge to any person obtaining a copy".split()
    out.append(row(900, "\n\n".join(draw.choice(words) for _ in range(600))))
    out.append(row(901, "\n\n".join([broken(LONG[0][1], 3), broken(LONG[1][1], 3)])))
    out.append(row(902, "\n\n\n\n".join(["is hereby granted"] * 50)))
    return out + awkward()


def test_published_licences_are_found(spark):
    got = {}
    for r in licenses.scan(table(spark, rows_of())).collect():
        got.setdefault(r.doc_id, {})[r.license] = r.dice
    for i, (name, _) in enumerate(LONG):
        for n in (1, 3, 4):
            assert got[100 + 10 * i + n].get(name, 0) > 0.95, (name, n)
    assert got[901][LONG[0][0]] > 0.95 and LONG[1][0] in got[901]


@pytest.mark.parametrize("kind", ["all"])
def test_scan_equals_its_sql(spark, kind):
    rows = rows_of()
    documents = pd.DataFrame([(r[0], r[1]) for r in rows], columns=["doc_id", "text"])  # noqa: F841  (read by duckdb)
    documents["doc_id"] = documents.doc_id.astype("Int64")
    want = duckdb.sql(licenses.oracle()).fetchall()
    got = licenses.scan(table(spark, rows)).select("doc_id", "license", "dice", "n_units").collect()
    def key(rows):
        return sorted(((r[0], r[1], round(r[2], 9), r[3]) for r in rows), key=str)
    assert key(got) == key(want)
