"""The SQL of the licence scan on lines that tell its rules apart."""

import duckdb

from compare import difference
from meterflow.llm import licenses
from meterflow.llm.oracle import ORACLES

LINES = [
    "copyright holder of this work agrees", "Copyright 2020 Some One", "copyright (c) acme", "(c) Some One", "(c) you may not", "(c) one two three four five six seven",
    "(c) one two three, all rights reserved by x", "(C) 1999", "© acme", "© the", "Copyright by the owner", "copyright the", "Copyright The Authors",
    "copyright the software is", "copyright law", "copyrighted works", "  // Copyright: yyyy", "Copyright [year] [name]", "# copyright <year>", "(c) copyright nobody",
    "(c)copyright", "copyright 12345", "copyright 1234", "All rights reserved.", "Released under the MIT licence", "(c) a", "(c) acme the", "(c) , x", "copyright", "x copyright 2020",
    "(c) one two three four five six", "(c) ACME; all rights reserved", "Copyright ©", "Copyright: rights", "copyright statements apply", "(c) a-b", "copyright your-name",
]


def test_sql_on_notice_lines(spark):
    rows = [(n, f"head\n{line}\ntail") for n, line in enumerate(LINES)]
    rows += [(100 + n, line) for n, line in enumerate(LINES)] + [(300, None), (301, ""), (302, "\n".join(LINES)), (302, "a\r\nCopyright 2001\r\n")]
    rows += [(400 + n, f"Copyright (c) 2020 Some One\n{body}") for n, (_, body) in enumerate(licenses.NOTICES) if len(body) < 3000]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    con = duckdb.connect()
    con.register("documents", frame.toPandas())
    assert difference(licenses.scan(frame), con, ORACLES["op4_licenses"]) is None
