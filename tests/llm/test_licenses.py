"""Licence matches against DuckDB and against planted notices."""

import duckdb

from oddsflow.llm import licenses
from oddsflow.llm.licenses import TEMPLATES, bounds, matches, template_bigrams


def sql(rows):
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    return sorted(con.execute(licenses.oracle_sql()).fetchall(), key=str)


def test_planted_and_edge_cases(spark):
    mit = TEMPLATES[2][1]
    rows = [(1, "prose\nReleased under the MIT License.\nmore prose"), (2, "RELEASED UNDER THE MIT LICENSE"), (3, mit.replace(" any ", "\n").replace("copies of", "some copies of")),
            (4, None), (5, ""), (6, "\n\n"), (7, "Licensed under CC BY-NC 4.0."), (8, "Licensed under CC BY 4.0.\n \t\nReleased under the MIT License."), (None, rows_text := "License"),
            (9, "the the the " * 5000), (1, "Released under the MIT License."), (10, "nothing here\nat all"), (11, "Lizenz für Éléments\nLicensed under the Apache License, Version 2.0.")]
    df = spark.createDataFrame([(i, t, 1, "s") for i, t in rows], "doc_id long, text string, row int, unit string").repartition(4)
    got = sorted((tuple(r) for r in matches(df).collect()), key=str)
    assert got == sql(rows)
    best = {r[0]: r[2] for r in got if r[0] not in (None, 1)}
    assert best == {2: "MIT", 3: "MIT", 4: None, 5: None, 6: None, 7: "CC-BY-NC-4.0", 8: "CC-BY-4.0", 9: None, 10: None, 11: "Apache-2.0"}
    assert matches(df.limit(0)).collect() == []


def test_notices_between_other_words(spark):
    long = {name: text for name, text in TEMPLATES if len(text) > 200}
    wrap = lambda text, leader: "\n".join(leader + " ".join(w) for w in (text.split()[i:i + 9] for i in range(0, len(text.split()), 9)))
    rows, want = [], {}
    for name, text in long.items():
        for leader in ("# ", " * ", "// ", "dnl ", "REM "):
            rows.append((len(rows), f"{leader}Copyright 2020 Some One and others\n{leader}\n" + wrap(text, leader) + f"\n{leader}\n{leader}The rest of the file is code.\nimport os\nprint(os.name)\n" + "x = 1\n" * 40))
            want[rows[-1][0]] = name
    said = {"The code is free. Released under the MIT License. See the file COPYING for details.": ("MIT", 1), "Prose, then: licensed under CC BY-NC 4.0, as all of it is, and more prose follows here.": ("CC-BY-NC-4.0", 1),
            "Either released under the MIT License. Or else, as the owner says, licensed under the Apache License, Version 2.0. So choose.": ("Apache-2.0", 2), "Released under the spell of the sea, he was given a licence to see the world.": (None, 0)}
    for text in said:
        rows.append((len(rows), text + " word" * 300))
    got = {r.doc_id: r for r in matches(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(s is None for _, _, s, _ in sql(rows[-len(said):]))  # what lines and paragraphs do not show
    assert {i: got[i].license for i in want} == want
    assert all(got[i].n_matches >= 1 and got[i].score >= 0.8 for i in want)
    for (i, _), (name, n) in zip(rows[-len(said):], said.values()):
        assert (got[i].license, got[i].n_matches) == (name, n), got[i]


def test_bounds_are_exact():
    for size in range(1, 60):
        low, high = bounds(size, 0.8)
        for n in range(1, 120):
            assert (low <= n <= high) == (2 * min(n, size) >= 0.8 * (n + size))


def test_templates_tell_each_other_apart():
    sets = [(name, set(template_bigrams(text))) for name, text in TEMPLATES]
    for i, (one, a) in enumerate(sets):
        for other, b in sets[:i]:
            assert one == other or a != b


def test_query_equals_its_sql(spark):
    from oddsflow.llm import queries
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    got = sorted((tuple(r) for r in queries.queries()["op7_license_scans"](spark, sf).collect()), key=str)
    assert got == sorted(con.execute(queries.oracle_sql()["op7_license_scans"]).fetchall(), key=str)
