"""License scans against a plain TF-IDF cosine and a walk up the path."""

import math
import re
from collections import Counter

import pytest

from panelcast.llm import licenses

SCHEMA = "doc_id long, path string, text string, license int"
FILES = [
    ("a/b/c/x.txt", "plain words of no licence interest"),
    ("a/b/c/y.txt", "Some text here. Licensed under CC BY-NC 4.0. More text"),
    ("a/b/LICENSE", "Released under the MIT License."),
    ("a/LICENSE", "Licensed under the Apache License, Version 2.0."),
    ("a/z.txt", "nothing"),
    ("a/b/q/r/s.txt", None),
    ("other/x.txt", ""),
    ("root.txt", "text"),
    (None, "This work is licensed under the GNU General Public License, version 3."),
    (None, "no path"),
    ("ab/x.txt", "the license of a driver is not a notice but licence talk about many other foreign things"),
    ("tie/COPYING", "Licensed under CC BY 4.0\nLicensed under CC BY-SA 4.0"),
    ("tie/deep/file", "word " * 30_000 + "\nReleased under the MIT License.\n" + "word " * 30_000),
]


def words(text):
    return re.findall(licenses.TERM, (text or "").lower())


def brute(files):
    n = len(files)
    df = Counter(w for _, t in files for w in set(words(t)))
    known = {w for _, t in licenses.TEMPLATES for w in words(t)}

    def vector(text):
        v = {w: (1 + math.log(k)) * (math.log((n + 1) / (df[w] * (w in known) + 1)) + 1) for w, k in Counter(words(text)).items()}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / size for w, x in v.items()}

    templates = [(name, vector(t)) for name, t in licenses.TEMPLATES]

    def nearest(text):
        v = vector(text)
        return min((-round(sum(x * t.get(w, 0) for w, x in v.items()), 9), name) for name, t in templates)

    own, of = [], {}
    for path, text in files:
        header = whole = None
        if re.search(licenses.CUES, text or "", re.I):
            for s in re.split(r"[.!?;]+[ \t]+|[\n-\r]+", text):
                if re.search(licenses.CUES, s, re.I):
                    header = min(filter(None, [header, nearest(s)]))
            header = header if header[0] <= -0.6 else None
            whole = nearest(text)
            whole = whole if whole[0] <= -0.6 else None
            if whole and path:
                d = path.rpartition("/")[0]
                of[d] = min(filter(None, [of.get(d), whole]))
        own.append((header, whole))
    out = []
    for (path, _), (header, whole) in zip(files, own, strict=True):
        if header or whole:
            out.append(((header or whole)[1], "header" if header else "file", None))
            continue
        d = path.rpartition("/")[0] if path else None
        while d and d not in of:
            d = d.rpartition("/")[0]
        out.append((of[d][1], "inherited", d) if d in of else (None, None, None))
    return out


def test_equals_brute_force(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    files = FILES + [FILES[1]]
    df = spark.createDataFrame([(i, p, t, 0) for i, (p, t) in enumerate(files)], SCHEMA)
    out = {r["doc_id"]: (r["license"], r["license_by"], r["license_from"]) for r in licenses.scan_licenses(df).collect()}
    assert [out[i] for i in range(len(files))] == brute(files)
    assert out[0] == ("MIT", "inherited", "a/b") and out[4][0] == "Apache-2.0" and out[1][0] == "CC-BY-NC-4.0"
    assert out[5][0] == "MIT" and out[12][:2] == ("MIT", "header") and out[10][0] is None


@pytest.mark.parametrize("name", sorted({n for n, _ in licenses.TEMPLATES}))
def test_templates_name_themselves(name):
    assert all(re.search(licenses.CUES, t, re.I) or "compliance" in t for n, t in licenses.TEMPLATES if n == name)


def test_empty_table(spark):
    assert licenses.scan_licenses(spark.createDataFrame([], SCHEMA)).count() == 0


def test_whole_licence_texts_speak_for_their_directories(spark):
    texts = dict(licenses.TEXTS)
    mit = "The MIT License (MIT)\n\n" + texts["MIT"].replace("Copyright (c)", "Copyright (c) 2019 Jane Roe and others")
    apache = texts["Apache-2.0"].replace("[yyyy] [name of copyright owner]", "2020 The Example Authors")
    files = [
        ("m/LICENSE", mit), ("m/src/a.py", "plain words"), ("p/LICENSE", apache), ("p/q/r/b.py", "other plain words"),
        ("g/COPYING", texts["GPL-3.0"]), ("g/x.c", "code"), ("b/LICENSE", texts["BSD-3-Clause"]), ("b/y.c", "code"),
        ("none/talk.txt", "a licence is a text on what others may do with a software " * 20), ("none/z.c", "code"),
    ]
    df = spark.createDataFrame([(i, p, t, 0) for i, (p, t) in enumerate(files)], SCHEMA)
    out = {r["path"]: (r["license"], r["license_by"], r["license_from"]) for r in licenses.scan_licenses(df).collect()}
    assert out["m/src/a.py"] == ("MIT", "inherited", "m") and out["p/q/r/b.py"] == ("Apache-2.0", "inherited", "p")
    assert out["g/x.c"] == ("GPL-3.0", "inherited", "g") and out["b/y.c"] == ("BSD-3-Clause", "inherited", "b")
    assert out["none/talk.txt"][0] is None and out["none/z.c"][0] is None
