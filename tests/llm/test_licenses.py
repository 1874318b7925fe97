import math
import random
import re

import pytest
from pyspark.sql import functions as F

from stratum.llm import licenses
from tests.llm.helpers import DOCS, documents


def split(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def runs(words):
    return [tuple(words[i : i + 5]) for i in range(len(words) - 4)]


def plain(rows, templates, least=0.8):
    """All windows of all texts against all templates."""
    out = set()
    for doc, text in rows:
        found = runs(split(text))
        for name, template in templates.items():
            wanted = set(runs(split(template)))
            length, stride = licenses.grid(1 << (len(wanted) - 1).bit_length())
            best = None
            for a in range(0, len(found), stride):
                share = len(wanted & set(found[a : a + length])) / len(wanted)
                if share >= least and (best is None or share > best[0]):
                    best = (share, a)
            if best:
                out.add((doc, name, round(best[0], 9), best[1], length + 4))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.license, round(r.containment, 9), r.first_word, r.n_words) for r in df.collect()), key=str)


def texts(seed):
    rng = random.Random(seed)
    filler = [f"f{i}" for i in range(300)] + ["the", "license"]
    rows = []
    for i in range(80):
        words = rng.choices(filler, k=rng.choice([0, 3, 20, 300]))
        for _ in range(rng.choice([0, 1, 2])):
            part = split(rng.choice(list(licenses.TEMPLATES.values())))
            for _ in range(rng.choice([0, 0, 1, 2])):
                part[rng.randrange(len(part))] = "changed"
            at = rng.randint(0, len(words))
            words[at:at] = part
        rows.append((i, rng.choice([" ", " - ", "\n"]).join(words).upper()))
    rows += [(900, None), (901, ""), (902, "MIT"), (None, "Released under the MIT License"), (903, "x " * 30_000 + licenses.TEMPLATES["MPL-2.0 (notice)"])]
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_every_window(spark, seed):
    rows = texts(seed)
    expected = plain(rows, licenses.TEMPLATES)
    assert got(licenses.scan(documents(spark, rows))) == expected and len(expected) > 40


def test_given_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    expected = plain(rows, licenses.TEMPLATES)
    assert got(licenses.scan(docs)) == expected and len(expected) > 5


def test_repeated_rows_clashes_and_empty_tables(spark):
    notice = licenses.TEMPLATES["MIT (statement)"]
    docs = documents(spark, [(1, notice), (1, notice), (2, notice), (2, notice + " x")], key=F.lit("k"), w=F.lit(1), license=F.lit("l"))
    assert [(r.doc_id, r.license) for r in licenses.scan(docs).orderBy("doc_id").collect()] == [(1, "MIT (statement)"), (2, "MIT (statement)"), (2, "MIT (statement)")]
    assert licenses.scan(spark.createDataFrame([], DOCS)).collect() == []
    none = spark.createDataFrame([], "license string, text string")
    assert licenses.scan(docs, none).collect() == []


def test_templates_out_of_bounds(spark):
    for text in ("four words are few", None, " ".join(map(str, range(600)))):
        with pytest.raises(ValueError):
            licenses.scan(documents(spark, []), spark.createDataFrame([("t", text)], "license string, text string"))


def test_bands_keep_the_promise():
    for top in (1, 2, 4, 8, 64, 512):
        window, stride = licenses.grid(top)
        for size in range(top // 2 + 1, top + 1):
            shared = math.ceil(0.8 * size - 1e-9)
            assert (1 - shared / (window + size - shared)) ** licenses.bands(top) <= licenses.MISS
            assert window >= size + stride - 1


def test_no_python_in_the_plan(spark):
    plan = licenses.scan(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapIn" not in plan and "Cartesian" not in plan


def test_long_many_and_unusable_templates(spark, monkeypatch):
    monkeypatch.setattr(licenses, "MAX_TEMPLATES", 2)
    long = " ".join(f"w{i}" for i in range(1500))
    wanted = {"long": long, "a": "one two three four five", "b": "six seven eight nine ten eleven", "c": "a b c d e f g"}
    rows = [(1, "x y z " * 50 + long + " end"), (2, long[:len(long) // 2]), (3, " ".join(wanted.values()))]
    templates = spark.createDataFrame([*wanted.items(), ("short", "four words are few"), ("none", None)], "license string, text string")
    found = got(licenses.scan(documents(spark, rows), templates, strict=False))
    assert found == plain(rows, wanted) and {(f[0], f[1]) for f in found} >= {(1, "long"), (3, "long"), (3, "c")}


def test_notices_alike_have_templates_of_their_own(spark):
    names = ["GPL-2.0 (notice)", "LGPL-2.1 (notice)", "LGPL-3.0 (notice)", "AGPL-3.0 (notice)", "GPL-3.0 (notice)", "ISC (permission)",
             "Unlicense (statement)", "BSD (disclaimer)"]
    found = licenses.scan(documents(spark, [(i, licenses.TEMPLATES[n]) for i, n in enumerate(names)])).collect()
    for i, name in enumerate(names):
        assert [r.license for r in found if r.doc_id == i and r.containment == 1] == [name]
