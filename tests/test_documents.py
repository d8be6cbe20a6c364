"""Record rules, runs, page routing and pluggable models on fixtures."""

import json

import pytest
from pyspark.sql import functions as F

from resma import problems, queries_documents
from resma.functions import geometry, numbers, text
from resma.operators import case_pages, models, pages, rejects, runs, sampling, validation

NUMBER = "0000001-55.2025.8.05.0274"


def number(i):
    body = f"{i:07}" + "20258050274"
    return f"{i:07}-{98 - int(body + '00') % 97:02}.2025.8.05.0274"


def record(i, **more):
    n = number(i)
    host = f"https://{queries_documents.HOST}"
    return {
        "url_download": f"{host}{queries_documents.DOWNLOAD}?numeroProcesso={n}", "process_number": n, "process_number_digits": n.replace("-", "").replace(".", ""), "process_year": 2025,
        "source_url": f"{host}{queries_documents.CASE}?numeroProcesso={i}", "codigo_hash": None, "projudi_internal_id": str(i), "distribution_at": "2025-04-03T12:02:17Z", "subject": "x", "is_secret": None, "classe": None,
        "datajud_subjects": ["a"], "orgao_julgador": None, "data_ajuizamento": "2025-04-02", "arquivos": {"links_detectados": 1, "restricoes_detectadas": 0}, "avisos": [],
    } | more


BAD = {
    "number_form": {"process_number": "1-2"}, "number_check": {"process_number": number(2)[:8] + "00" + number(2)[10:]}, "digits_differ": {"process_number_digits": "1"}, "year_differs": {"process_year": 2025.0}, "internal_id": {"projudi_internal_id": "x1"},
    "url_download": {"url_download": "https://projudi.tribunal.example/other?numeroProcesso=1"}, "source_url": {"source_url": "https://elsewhere.example/projudi/listagens/DadosProcesso?numeroProcesso=2"}, "codigo_hash": {"codigo_hash": ""}, "is_secret": {"is_secret": 0},
    "dates_are_text": {"data_ajuizamento": 5}, "distribution_offset": {"distribution_at": "2025-04-03T12:02:17"}, "filing_date": {"data_ajuizamento": "2025-02-30"}, "nullable_texts": {"classe": 3}, "text_lists": {"avisos": None}, "counts": {"arquivos": {"links_detectados": -1, "restricoes_detectadas": 0}},
}


def test_record_rules_name_the_first_fault(spark):
    rows = [(0, json.dumps(record(2))), (1, "{}"), (2, "[]"), (3, None), (4, "{"), (5, json.dumps(record(2)) + "{}"), (6, '{"a":1,"a":2}'), (7, json.dumps(record(2, datajud_subjects=["a", None]))), (8, json.dumps(record(2, datajud_subjects=["a", 1])))]
    rows += [(100 + i, json.dumps(record(2) | change)) for i, change in enumerate(BAD.values())]
    got = {r["i"]: r["fault"] for r in validation.checked_records(spark.createDataFrame(rows, "i int, raw_json string"), queries_documents._rules).collect()}
    assert [got[i] for i in range(9)] == [None, "missing_fields", "object", "object", "object", "object", "object", "text_lists", "text_lists"]
    assert [got[100 + i] for i in range(len(BAD))] == list(BAD)


def test_first_seen_and_first_error(spark):
    rows = spark.createDataFrame([("f", 1, "a", "x", None), ("f", 2, "b", "x", "late"), ("f", 3, "a", "y", "z"), ("f", 4, None, None, None), ("f", 5, None, None, None), ("g", 1, "a", "x", None)], "f string, n int, p string, q string, fault string")
    got = {(r["f"], r["n"]): r["duplicate_of"] for r in validation.first_seen(rows, "f", "n", ["p", "q"]).collect()}
    assert got == {("f", 1): None, ("f", 2): 1, ("f", 3): 1, ("f", 4): None, ("f", 5): None, ("g", 1): None}
    assert [tuple(r) for r in validation.first_error(rows, "f", "n", "fault").collect()] == [("f", 2, "late")]


def test_strict_objects(spark):
    lines = spark.createDataFrame([('{"a":1}',), ('{"a":1}{}',), ('{"a":NaN}',), (None,), ("[1]",)], "raw_json string")
    assert [r["record"] is not None for r in rejects.strict_objects(lines).collect()] == [True, False, False, False, False]


def serial_repair(roles, counters, evidence, supported, closing):
    """Chains of printed counters, page by page."""
    out, done = dict(roles), set()
    for n in sorted(roles):
        c = counters.get(n)
        if n in done or roles[n] not in "AB" or not c or c[0] != 1 or c[1] == 1:
            continue
        chain = [n]
        while (m := chain[-1] + 1) in roles and roles[m] not in "ABFU" and m in evidence and (roles[m] in "CE" or m in supported):
            chain.append(m)
        last = chain[-1]
        if len(chain) > 1 and (roles[last] == "E" or last in closing or (counters.get(last) == (c[1], c[1]) and c[1] == len(chain))):
            out.update({m: "C" for m in chain} | {n: "A", last: "E"})
            done.update(chain)
    return out


def test_repaired_roles_against_serial_statement(spark):
    import random

    r = random.Random(4)
    rows, want = [], {}
    for d in range(60):
        roles = {n: r.choice("AABCCENNFU") for n in range(1, 12) if r.random() > 0.07}
        counters = {n: (r.choice([1, 1, 2, 3]), r.choice([1, 2, 3])) for n in roles if r.random() > 0.3}
        evidence, supported, closing = ({n for n in roles if r.random() > q} for q in (0.3, 0.4, 0.7))
        # a page whose predecessor is missing has nothing to continue
        evidence = {n for n in evidence if n - 1 in roles}
        want |= {(d, n): x for n, x in serial_repair(roles, counters, evidence, supported, closing).items()}
        rows += [(d, n, x, counters.get(n), "yes" if n in evidence else None, n in supported, n in closing) for n, x in roles.items()]
    frame = spark.createDataFrame(rows, "d int, n int, role string, k struct<page:int,of:int>, continues string, supported boolean, closing boolean")
    got = pages.repaired_roles(frame.repartition(5), ["d"], "n", "role", "k", "continues", F.col("supported"), F.col("closing")).collect()
    assert {(x["d"], x["n"]): x["resolved"] for x in got} == want
    assert {x["reason"] for x in got if x["role"] != x["resolved"]} <= {"numbered_continuation"}


def test_content_ranges_fall_back(spark):
    ranges = spark.createDataFrame([("a", 1, 2), ("a", 3, 5), ("b", 1, 2), ("b", 4, 5), ("c", 1, 5)], "s string, start int, stop int")
    docs = spark.createDataFrame([("a", 5), ("b", 5), ("c", 5), ("d", 3)], "s string, last int")
    got = {tuple(r) for r in pages.content_ranges(ranges, docs, ["s"], "start", "stop", "last", alone=F.col("s") == "c").collect()}
    assert got == {("a", 1, 2, True), ("a", 3, 5, True), ("b", 1, 5, False), ("c", 1, 5, False), ("d", 1, 3, False)}


def test_probes_and_residual(spark):
    ranges = spark.createDataFrame([("a", 1, 50, True, False), ("a", 51, 100, True, True)], "s string, start int, stop int, indexed boolean, titled boolean")
    book = spark.createDataFrame([("a", n, n == 60, n == 20) for n in range(1, 101)], "s string, n int, hit boolean, unsure boolean")
    plan = {r["start"]: (r["hit"], r["selected"], r["place"]) for r in pages.planned_groups(ranges, book, ["s"], "start", "stop", "n", F.col("hit"), F.when(F.col("titled"), 8).otherwise(0), 4).collect()}
    assert plan == {1: (False, False, None), 51: (False, True, 1)}  # page 60 is no probe
    done = spark.createDataFrame([("a", 19)], "s string, n int")
    rest = sorted(r["n"] for r in pages.residual_pages(ranges, book, ["s"], "start", "stop", "n", F.lit(False), F.col("titled"), F.col("unsure"), done).collect())
    assert rest == [20, 21, *range(51, 101)]


def test_boundaries(spark):
    roles = "AENCNBC"
    book = spark.createDataFrame([("d", i + 1, r, "x" if i in (4, 6) else None) for i, r in enumerate(roles)], "d string, n int, role string, continues string")
    assert {(r["n"], r["why"]) for r in pages.boundary_suspects(book, ["d"], "n", "role", "continues").collect()} == {(6, "early_end")}
    gap = spark.createDataFrame([("d", i + 1, r, None) for i, r in enumerate("ANC")], book.schema)
    assert [(r["n"], r["why"]) for r in pages.boundary_suspects(gap, ["d"], "n", "role", "continues").collect()] == [(2, "gap")]
    ranges = spark.createDataFrame([("d", 1, 3), ("d", 4, 6), ("d", 7, 7)], "d string, start int, stop int")
    assert {(r["stop"], r["start"]) for r in pages.crossing_candidates(ranges, book, ["d"], "start", "stop", "n", "role", "continues").collect()} == {(6, 7)}
    alone = pages.resolved_roles(book, ["d"], "n", "role", F.col("n") == 1).where("reason IS NOT NULL").collect()
    assert [(r["n"], r["role"]) for r in alone] == [(1, "N")]


def test_runs(spark):
    events = spark.createDataFrame([("r", 1, "start", "t1", None, None, None), ("r", 2, "attempt:page", "t2", None, None, None), ("r", 3, "finish", "t3", "failed", None, "e" * 600), ("r", 4, "finish", "t4", "done", 7, None), ("q", 1, "attempt:pdf", "t1", None, None, None)], "run string, seq int, kind string, at string, status string, bytes long, error string")
    got = {r["run"]: r for r in runs.run_states(events, "run", "seq").collect()}
    assert (got["r"]["status"], got["r"]["bytes"], got["r"]["error"], got["r"]["page_attempts"]) == ("done", 7, None, 1) and got["q"]["status"] == "running"
    failed = runs.run_states(events.where("seq < 4"), "run", "seq").where("run = 'r'").collect()[0]
    assert failed["status"] == "failed" and len(failed["error"]) == 500
    manifest = spark.createDataFrame([("a", "1", 1), ("b", "2", 2), ("c", "3", 3)], "path string, sha256 string, size_bytes long")
    found = spark.createDataFrame([("a", "1", 1), ("b", "x", 2), ("d", "4", 4)], manifest.schema)
    assert {tuple(r) for r in runs.verified(manifest, found).collect()} == {("a", "same"), ("b", "changed"), ("c", "missing"), ("d", "extra")}
    releases = spark.createDataFrame([(1, "completed", "both", True), (2, "completed", "both", True), (3, "failed", "both", True), (4, "completed", "both", True)], "k int, status string, mode string, source_retained boolean")
    outputs = spark.createDataFrame([(1, True), (2, True), (2, None), (3, True)], "k int, intact boolean")
    assert {r["k"]: r["purge"] for r in runs.purgeable(releases, outputs, "k").collect()} == {1: True, 2: False, 3: False, 4: False}
    report = runs.summary_report("t", {"counts": spark.createDataFrame([("a|b", None)], "x string, y int")})
    assert report == "# t\n\n## counts\n\n| x | y |\n| --- | --- |\n| a\\|b |  |\n"
    own, same = runs.frozen_configuration({"b": 1, "a": [2]})
    assert same({"a": [2], "b": 1}) and not same({"a": [2], "b": 2}) and len(own) == 64


def test_export_batch(spark, tmp_path):
    rows = spark.createDataFrame([(2, "b"), (1, None)], "position int, v string")
    for _ in range(2):
        runs.export_batch(rows, str(tmp_path), "position", rows.groupBy("v").count())
    assert [r["position"] for r in spark.read.json(f"{tmp_path}/results").collect()] == [1, 2]
    assert spark.read.json(f"{tmp_path}/manifest").count() == 2


def test_models(spark):
    asked = []

    def make():
        return lambda texts: [None if t == "long" else json.dumps({"role": t.upper()}) for t in texts]

    frame = spark.createDataFrame([("1", "a"), ("1", "a"), ("2", "b"), ("3", "long")], "k string, t string")
    cache = spark.createDataFrame([("2", '{"role":"kept"}')], "k string, answer string")
    got = {r["k"]: (r["answer"], r["cached"]) for r in models.asked(frame, "k", "t", make, cache).collect()}
    assert got == {"1": ('{"role": "A"}', False), "2": ('{"role":"kept"}', True), "3": (None, False)} and not asked
    answers = spark.createDataFrame([('{"n": 1}',), ('{"n": true}',), ('{"n": "1"}',), ("{", ), (None,), ("[]",)], "a string")
    assert [r[0] is not None for r in answers.select(models.checked_answer(F.col("a"), "struct<n: bigint>", lambda a: a["n"] >= 1)).collect()][0] is True
    keys = spark.createDataFrame([("a", None), ("a", ""), (None, "a")], "x string, y string").select(models.request_key(F.col("x"), F.col("y")).alias("k")).collect()
    assert len({r["k"] for r in keys}) == 3
    data = b"%PDF-1.7 body %%EOF"
    import hashlib

    files = spark.createDataFrame([("a", bytearray(data)), ("b", bytearray(b"x")), ("c", None), ("d", bytearray(data.replace(b"%%EOF", b""))), ("e", bytearray(data + b" "))], "path string, content binary")
    sha = hashlib.sha256(data).hexdigest()
    assert [r[0] for r in files.select(models.file_faults(F.col("content"), F.lit(sha), F.lit(1))).collect()] == [None, "size", "size", "end_marker", "hash"]
    units = models.read_units(files.where("path IN ('a', 'b')"), "path", "content", lambda: lambda b: [(1, b.decode())] if len(b) > 1 else 1 / 0).orderBy("path").collect()
    assert [(u["path"], u["number"], u["error"] is None) for u in units] == [("a", 1, True), ("b", None, False)]


def test_regions(spark):
    def run(f, *rects):
        return [tuple(r) for r in spark.range(1).select(f(F.array(*[geometry.box(*map(F.lit, r)) for r in rects]))).collect()[0][0]]

    whole, near, small, bad = (0.0, 0.0, 1.0, 1.0), (0.1, 0.1, 0.5, 0.5), (0.1, 0.1, 0.2, 0.2), (0.5, 0.5, 0.4, 0.6)
    assert run(geometry.admitted, whole, near, (0.103, 0.1, 0.5, 0.5), small, bad, (0.0, 0.0, 0.99, 1.0)) == [whole, near]
    assert run(geometry.graphics, small, near, (0.0, 0.1, 0.7, 0.15), bad) == [small]
    words = "array<struct<x0:double,y0:double,x1:double,y1:double,text:string>>"
    frame = spark.createDataFrame([([(0.2, 0.2, 0.3, 0.3, "in"), (0.8, 0.8, 0.9, 0.9, "out")],)], f"w {words}")
    got = frame.select(geometry.cropped(F.col("w"), geometry.box(*map(F.lit, (0.0, 0.0, 0.5, 0.5))))).collect()[0][0]
    assert [(round(w[0], 6), round(w[2], 6), w[4]) for w in got] == [(0.4, 0.6, "in")]
    box = spark.range(1).select(geometry.pixel_box(geometry.box(*map(F.lit, (0.1004, 0.0, 0.5, 1.0))), 1000, 10), geometry.pixel_box(geometry.box(*map(F.lit, bad)), 10, 10)).collect()[0]
    assert tuple(box[0]) == (100, 0, 500, 10) and box[1] is None


def test_urls(spark):
    fault = lambda x: text.url_fault(x, "h.example", path="/p", parameter="n")
    cases = {"https://h.example/p?n=a-1": None, "https://h.example:443/p?n=a": None, "http://h.example/p?n=a": "scheme", "https://x.h.example/p?n=a": "host", "https://u:p@h.example/p?n=a": "credentials", "https://h.example:444/p?n=a": "port",
             "https://h.example/p?n=a#": "fragment", "https://h.example/q?n=a": "path", "https://h.example/p?n=a&m=1": "parameters", "https://h.example/p?n=": "parameters", "": "malformed", "no url": "malformed", None: "malformed"}
    frame = spark.createDataFrame([(u,) for u in cases], "u string")
    assert [r[0] for r in frame.select(fault(F.col("u"))).collect()] == list(cases.values())
    below = spark.createDataFrame([("https://h.example/a/b",), ("https://h.example/b",)], "u string").select(text.url_fault(F.col("u"), "h.example", prefix="/a/")).collect()
    assert [r[0] for r in below] == [None, "path"]


def test_splits(spark):
    rows = spark.createDataFrame([(f"d{i}", f"c{i // 2}") for i in range(20)], "d string, c string")
    assert sampling.checked_split(rows, ["d"], {"a": 5, "b": 6}, 1).count() == 11
    with pytest.raises(ValueError):
        sampling.checked_split(rows, ["d"], {"a": 15, "b": 6}, 1)
    with pytest.raises(ValueError):
        sampling.checked_split(rows, ["d", "c"], {"a": 10, "b": 10}, 1)
    import random

    keys = sorted(f"d{i}" for i in range(20))
    first = set(random.Random(7).sample(keys, 5))
    second = set(random.Random(8).sample([k for k in keys if k not in first], 6))
    got = {(r["d"], r["role"]) for r in sampling.prng_split(rows, "d", {"a": 5, "b": 6}, 7).collect()}
    assert got == {(k, "a") for k in first} | {(k, "b") for k in second}


def test_case_pages():
    labels = case_pages.Labels("segredo", "distribuição", "assunto", ("/c", "n"))
    page = lambda secret, link="<a href='/c?n=7'>0001</a>": f"<body>{link}<table><tr><td>Segredo:</td><td>{secret}</td></tr><tr><td>Distribuição</td><td>3 de abril</td></tr></table>".encode()
    assert case_pages.read_case(page("Não"), None, labels, "0001", "7") == ("0001", "7", False, "3 de abril", None, None)
    assert case_pages.read_case(page("Sim"), None, labels) == ("0001", "7", True, None, None, None)
    assert case_pages.read_case(page("?"), None, labels)[2] is None
    assert case_pages.read_case(page("Não", ""), None, labels, "0001")[5] == "identity"
    assert case_pages.read_case(page("Não"), None, labels, "0002")[5] == "identity"
    assert case_pages.read_case(None, None, labels)[5] == "empty"
    assert case_pages.read_case("<p>Não sou um robô</p>".encode(), None, labels)[5] == "challenge"
    assert case_pages.decoded("é".encode("utf-32")) == "é"


def test_retries(spark):
    now = F.lit("2026-01-01").cast("timestamp")
    rows = spark.createDataFrame([(1, None), (2, None), (9, None), (1, "90"), (1, "3"), (1, "Thu, 01 Jan 2026 00:00:30 GMT")], "a int, h string")
    got = [(r[0]["wait"], r[0]["pause"]) for r in rows.select(numbers.retry(F.col("a"), F.col("h"), now, F.lit(0.5))).collect()]
    assert got == [(5.5, False), (15.5, False), (15.5, False), (90.0, True), (3.0, False), (30.0, False)]


@pytest.mark.parametrize("name", ["p2_found", "p2_loaded", "p4_found", "p4_adjacency", "p4_subjects", "p4_courts"])
def test_problems_against_sql(spark, data, name):
    import os

    import duckdb

    db = duckdb.connect()
    for f in os.listdir(data):
        db.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{data}/{f}'")
    frame = problems.QUERIES[name](spark, data)
    got = db.execute(problems.SQL[name])
    names = [d[0] for d in got.description]
    assert sorted(names) == sorted(frame.columns)
    assert sorted(map(repr, (tuple(r) for r in frame.select(*names).collect()))) == sorted(map(repr, got.fetchall()))


def test_command_line(spark, data, tmp_path, capsys):
    from resma import cli

    assert cli.main(["list"]) == 0 and "p2_found" in capsys.readouterr().out
    assert cli.main(["run", "nothing", "--data", data]) == 2 and cli.main(["run"]) == 2
    assert cli.main(["run", "agg_status", "--data", data, "--out", str(tmp_path / "o")], spark) == 0
    assert spark.read.parquet(str(tmp_path / "o")).count() > 1
    assert cli.main(["status", "--data", data], spark) == 0 and cli.main(["validate", "--data", data], spark) == 1
