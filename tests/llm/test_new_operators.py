"""Periodic runs, fill-in-the-middle and license scans against plain versions."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.test_operators import ODD, docs_of, given_rows  # noqa: F401  (fixture)
from tradeloom.llm import fill_middle, license_scan, periodic_runs
from tradeloom.llm import queries as q

REPEATS = [
    (101, "a b a b a b a b c"), (102, "x " * 40), (103, "one two three " * 5 + "four"), (104, "p q r p q r p q"),
    (105, "a a a a a b a a a a a"), (106, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 w15 w16 w17 w18"),
    (107, "z y z y z y z y z y x y x y x y x y x y"), (108, " ".join(["the cat sat"] * 30 + ["dog"] * 9)),
]
LICENSES = [
    (201, "Copyright (c) 2020 Jane Doe\n\n" + license_scan.TEMPLATES[0][1].replace("[[copyright <<year and holder>>]]", "")
     .upper()),
    (202, "Some code\nThis library is free software; you can redistribute it and/or modify it under the terms of the GNU"
          " Lesser General Public License as published by the Free Software Foundation; version 2.1 gnu general public"
          " license"),
    (203, "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
          "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    (204, "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
          " the following conditions are met: 1. Redistributions of source code must retain the above copyright notice,"
          " this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
          "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
          "other materials provided with the distribution. 3. Neither the name of the Foo Bar Project nor the names of "
          "its contributors may be used to endorse or promote products derived from this software without specific "
          "prior written permission."),
    (205, "Licensed under the Apache License, Version 2.0 (the \"License\"); you may use this file"),
    (206, "mit license and MIT License; cc by 4.0, cc-by-sa; apache license apache license"),
    (207, "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
          "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    (208, "this is free software"), (209, "this one two three four five six seven eight nine ten eleven twelve thirteen"
                                          " is free software you can redistribute it"),
]


def _rows(found, columns):
    return sorted((tuple(r[c] for c in columns) for r in found.collect()), key=repr)


def test_periodic_runs(spark, given_rows):
    rows = [*ODD, *REPEATS, *given_rows[:60]]
    rows += [(d, t) for d in range(300, 400) if __import__("zlib").crc32(str(d).encode()) % 10 == 0
             for t in ["alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho"]]
    found = periodic_runs.periodic_runs(docs_of(spark, rows))
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert _rows(found, columns) == sorted((brute.periodic(t, d) for d, t in rows), key=repr)
    assert periodic_runs.periodic_runs(docs_of(spark, []) ).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_runs_of_random_sequences(seed):
    rnd = random.Random(seed)
    for _ in range(400):
        seq = [rnd.randint(0, rnd.randint(1, 3)) for _ in range(rnd.randint(0, 60))]
        assert periodic_runs.find_runs(seq) == brute.all_runs(seq)


@pytest.mark.parametrize("seed", range(20))
def test_stretches_hold_every_run_that_counts(seed):
    """Trees are built for the stretches alone, and the runs of six words and four periods stay the same."""
    rnd = random.Random(seed)
    ids = [rnd.randrange(rnd.choice((2, 5, 9))) for _ in range(150)]
    for _ in range(4):
        a, p = rnd.randrange(140), rnd.randint(1, 4)
        for i in range(a + p, min(150, a + rnd.randint(4, 30))):
            ids[i] = ids[i - p]
    parts = periodic_runs.stretches(np.array(ids))
    found = sorted((at + s, n, p) for at, stop in parts for s, n, p in periodic_runs.find_runs(ids[at:stop])
                   if n >= max(6, 4 * p))
    assert found == [r for r in periodic_runs.find_runs(ids) if r[1] >= max(6, 4 * r[2])]


def test_words_that_repeat_less_than_four_times_cut_a_text():
    assert periodic_runs.stretches(np.arange(1000)) == []
    assert periodic_runs.stretches(np.array([9, *[1, 2] * 4, 8, 7, *[3] * 5])) == [(1, 9)]


def test_periodic_query(spark, small_data, given_rows):
    got = _rows(q.op11_periodic_runs(spark, small_data), q.op11_periodic_runs(spark, small_data).columns)
    assert got == sorted((brute.periodic(t, d) for d, t in given_rows), key=repr)


def _fim_brute(doc_id, text):
    t = text or ""
    hx = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(hx[8 * i:8 * i + 8], 16) for i in range(4)]
    import re
    lines = re.findall(r"[^\n]*\n|[^\n]+", t)
    n = len(lines)
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 100:
        return doc_id, n, "plain", None, None, t
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    form = "spm" if h[3] % 100 < 50 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, n, form, len(p), len(m), out


def test_fill_in_middle(spark, given_rows):
    rows = [*ODD, *REPEATS, *given_rows, (301, "a\n\nb\n"), (302, "<S\n<\n<M\n>>"), (303, "\n" * 50), (304, "ü\n😀" * 9)]
    made = fill_middle.fill_in_middle(docs_of(spark, rows)).withColumn(
        "back", fill_middle.restored(F.col("output"), F.col("form")))
    got = made.collect()
    assert sorted((tuple(r)[:6] for r in got), key=repr) == sorted((_fim_brute(d, t) for d, t in rows), key=repr)
    assert sorted((r.doc_id, r.back) for r in got if r.doc_id is not None) == sorted(
        (d, t or "") for d, t in rows if d is not None)
    assert all(r.back == fill_middle.restore(r.output, r.form) for r in got)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fill_middle.fill_in_middle(docs_of(spark, [])).count() == 0


def test_wavelet_matrix_rank_and_select():
    rnd = random.Random(5)
    codes = fill_middle.np.array([rnd.randint(0, 3) for _ in range(500)], dtype=fill_middle.np.uint8)
    matrix = fill_middle.WaveletMatrix(codes)
    for c in range(4):
        places = [i for i, x in enumerate(codes) if x == c]
        for end in range(0, 501, 7):
            assert matrix.rank(c, end) == sum(1 for p in places if p < end)
        for k, place in enumerate(places, 1):
            assert matrix.select(c, k) == place


def test_license_scan(spark, given_rows):
    rows = [*ODD, *LICENSES, *given_rows]
    got = _rows(license_scan.summary(license_scan.scan_licenses(docs_of(spark, rows))), [
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])
    expected = sorted(((d, *brute.licenses(t, license_scan.BASE, license_scan.TEMPLATES, license_scan.SLOT))
                       for d, t in rows), key=repr)
    assert got == expected
    labels = {r[0]: r[6] for r in got}
    assert labels[201] == "mit-text" and labels[202] == "gpl,gpl-notice" and labels[203] == "apache,apache-2.0-notice"
    assert labels[204] == "bsd-3-clause" and labels[205] == "apache" and labels[207] == "isc-text"
    assert labels[206] == "apache,cc-by,mit" and labels[209] == ""
    assert license_scan.scan_licenses(docs_of(spark, [])).count() == 0


def test_license_query(spark, small_data, given_rows):
    query = q.op13_license_scan(spark, small_data)
    assert _rows(query, query.columns) == sorted(((d, *brute.licenses(
        t, license_scan.BASE, license_scan.TEMPLATES, license_scan.SLOT)) for d, t in given_rows), key=repr)
