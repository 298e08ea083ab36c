"""Storage and plan mechanisms: buckets, one household base, keyed updates, broken lines, fingerprints, reruns."""

import collections
import os
import re

import pytest
from pyspark.sql import functions as F
from survey_helpers import rows, rule, rule_sheet

from contract.queries import CRITERIA, END, START
from contract.queries import rule_sheet as given_rules
from contract.tables import given, survey_tables
from surveyqa import SurveyTables, correct_table, schemas, validate
from surveyqa.operators import compare
from surveyqa.operators.keys import marked
from surveyqa.plans import full_run
from surveyqa.plans.cleaning import cleaning_extract, correct_snapshot, unused_corrections
from surveyqa.plans.productivity import add_batch, file_counts
from surveyqa.plans.validate import cross_module_check
from surveyqa.session import is_whole, staged_once
from surveyqa.sinks import write_by, write_consolidated
from surveyqa.sources import read_table, read_violation_file, write_table
from surveyqa.sources.bucketed import load_bucketed, write_bucketed
from surveyqa.sources.files import read_group_files
from surveyqa.sources.records import records
from surveyqa.streaming import stream_mismatch

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
on_given = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="given tables are not here")
WINDOW = ("2023-09-01", "2023-09-30")


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    before = {}

    def change(**settings):
        for key, value in settings.items():
            name = "spark.sql." + key.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def final_plan(df):
    """The plan that ran, without the first one; a reused exchange is printed without what is below it."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("Initial Plan")[0]


def children(plan, node):
    """The parts of a printed plan below the first such node."""
    lines = plan.splitlines()
    at = next(k for k, line in enumerate(lines) if re.search(rf"[-\s)]{node}$", line.rstrip()))
    parts, mark = [], None
    for line in lines[at + 1:]:
        found = re.match(r"[ :]*[:+]- ", line)
        if found and mark is None:
            mark = found.end()
        if found and found.end() == mark:
            parts.append([])
        elif found and found.end() < mark:
            break
        if parts:
            parts[-1].append(line)
    return ["\n".join(p) for p in parts]


def counts(df):
    plan = final_plan(df)
    return plan.count("SortMergeJoin"), len(re.findall(r"\bExchange ", plan)), plan


# -- one household base --------------------------------------------------------------------------


@on_given
def test_rules_of_a_sheet_share_one_household_base(spark, conf):
    conf(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    tables = survey_tables(spark, SF_DIR)
    joins, exchanges, _ = counts(validate(tables, given_rules(spark), START, END).violations)
    assert joins <= 10 and exchanges <= 20
    joins, _, _ = counts(cross_module_check(tables, START, END))
    assert joins <= 6
    criteria = spark.createDataFrame(CRITERIA, schemas.CLEANING)
    joins, _, _ = counts(cleaning_extract(tables, criteria, START, END).extract)
    assert joins <= 6


def test_two_rules_of_one_name_from_two_tables(spark, tables):
    """Exports of the same variable by criteria on different tables stay apart."""
    criteria = spark.createDataFrame(
        [("a", "P10C21 = 2", "P10C21"), ("b", "P01H10 = 4", "P01H09, P01H10"), ("c", "PPA03 = 30 y P01H09 = 0", "PPA03, P01H10")], schemas.CLEANING
    )
    extract, rejected = cleaning_extract(tables, criteria, *WINDOW)
    assert rejected.count() == 0
    assert rows(extract, "nombre", "vivienda", "cp", "personas.ppa03", "vivienda.p01h09", "vivienda.p01h10") == [
        ("a", 4, 1, None, None, None), ("b", 4, 0, None, 0, 4), ("c", 4, 1, 30, None, 4)
    ]


# -- buckets -------------------------------------------------------------------------------------


@on_given
def test_bucketed_bases_join_without_a_shuffle_of_households(spark, conf, tmp_path):
    tables = survey_tables(spark, SF_DIR)
    keys = write_bucketed(tables, str(tmp_path / "b"), 4)
    halves = load_bucketed(spark, str(tmp_path / "b"), keys, 4)
    expected = rows(validate(tables, given_rules(spark), START, END).violations)
    found = [validate(t, given_rules(spark), START, END).violations for t in halves]
    assert rows(found[0].unionByName(found[1])) == expected and len(expected) > 100
    conf(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    plan = final_plan(validate(halves.bucketed, given_rules(spark), START, END).violations)
    assert not re.search(r"hashpartitioning\(LEVEL-1-ID", plan) and "Bucketed: true" in plan


def test_large_households_are_kept_apart(spark, tables, tmp_path):
    hot = spark.range(400).selectExpr("1L AS `LEVEL-1-ID`", "CAST(id AS INT) AS CP", "if(id % 2 = 0, NULL, CAST(id AS INT)) AS PPA03", "1 AS PPA10")
    persons = tables.tables[("personas", "PR")].select("LEVEL-1-ID", "CP", "PPA03", "PPA10").filter("`LEVEL-1-ID` <> 1").unionByName(hot)
    survey = SurveyTables({**tables.tables, ("personas", "PR"): persons})
    keys = write_bucketed(survey, str(tmp_path / "b"), 4)
    halves = load_bucketed(spark, str(tmp_path / "b"), keys, 4)
    assert halves.large.tables[("personas", "PR")].filter("`LEVEL-1-ID` = 1").count() == 400
    assert (1,) in rows(halves.large.tables[("level-1", "PR")], "LEVEL-1-ID")
    assert halves.bucketed.tables[("personas", "PR")].filter("`LEVEL-1-ID` = 1").count() == 0
    sheet = rule_sheet(spark, rule("PPA03 es vacio", "P1"), rule("P01H10 es vacio", "H1"))
    found = [validate(t, sheet, *WINDOW).violations for t in halves]
    assert rows(found[0].unionByName(found[1])) == rows(validate(survey, sheet, *WINDOW).violations)
    # A second session finds the same tables by their folder.
    again = load_bucketed(spark.newSession(), str(tmp_path / "b"), keys, 4)
    assert again.bucketed.tables[("personas", "PR")].count() + again.large.tables[("personas", "PR")].count() == persons.count()


# -- keyed updates -------------------------------------------------------------------------------


def sheet_of(spark, *entries):
    columns = "depto long, mupio long, sector long, estructura long, vivienda long, hogar long, cp long, variable string, `valor nuevo` string, seq long, round string"
    return spark.createDataFrame([(1, 2, 100 + h % 2, 1, h, 1, *e) for h, *e in entries], columns)


@pytest.fixture
def both(tables):
    return SurveyTables({**tables.tables, ("personas", "SR"): tables.tables[("personas", "PR")].filter("CP <> 3")})


def test_corrections_go_to_the_round_they_name(spark, both):
    sheet = sheet_of(
        spark, (1, 1, "personas.ppa03", "41", 1, "PR"), (1, 2, "personas.ppa03", "42", 2, "SR"), (1, 1, "personas.ppa03", "43", 3, None),
        (1, 2, "personas.ppa03", "44", 4, "XX"),
    )
    for survey_round, expected in (("PR", [(1, 41), (2, None), (3, 12)]), ("SR", [(1, 40), (2, 42)])):
        new, audit = correct_table(both, ("personas", survey_round), sheet, ["PPA03"])
        assert rows(new.filter("`LEVEL-1-ID` = 1"), "CP", "PPA03") == expected and audit.count() == 1


def test_every_unused_correction_is_listed(spark, both):
    sheet = sheet_of(
        spark, (1, 1, "personas.ppa03", "41", 1, "PR"), (1, 1, "personas.ppa03", "42", 5, "PR"), (1, 9, "personas.ppa03", "43", 2, "PR"),
        (1, 3, "personas.ppa03", "44", 3, "SR"), (1, 2, "personas.ppa03", "45", 4, None), (8, 1, "personas.ppa03", "46", 6, "PR"),
        (1, 2, "personas.ppa03", "x", 7, "PR"), (1, 1, "vivienda.p01h10", "1", 8, None), (1, 2, "vivienda.p01h10", "2", 9, "PR"),
        (1, None, "personas.p10c21", "3", 10, "PR"), (1, 0, "personas.p10c21", "4", 11, "PR"), (1, 1, "personas.p99", "4", 12, "PR"),
        (1, 1, None, "4", 13, "PR"), (2, None, "personas.ppa03", "47", 14, "PR"),
    )
    found = {seq: reason for seq, _, _, reason in rows(unused_corrections(both, sheet))}
    assert found == {
        1: "reemplazada", 2: "persona desconocida", 3: "persona desconocida", 4: "ronda ambigua", 6: "hogar desconocido",
        7: "valor no convertible", 8: "reemplazada", 10: "reemplazada", 12: "variable desconocida", 13: "sin variable o valor",
    }


def test_rows_without_a_correction_are_not_shuffled(spark, conf, tmp_path):
    conf(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    spark.range(20_000).selectExpr("id div 4 AS `LEVEL-1-ID`", "CAST(id % 4 AS INT) AS CP", "1 AS PPA03").write.parquet(str(tmp_path / "p"))
    places = spark.range(5000).selectExpr(
        "id AS `LEVEL-1-ID`", "concat('c', id) AS `CASE-ID`", "1L AS DEPTO", "2L AS MUPIO", "100 + id % 2 AS SECTOR", "1L AS ESTRUCTURA", "id AS VIVIENDA", "1L AS HOGAR"
    )
    table = spark.read.parquet(str(tmp_path / "p"))
    survey = SurveyTables({("personas", "PR"): table, ("level-1", "PR"): places})
    sheet = sheet_of(spark, *[(h, 2, "personas.ppa03", "7", h, "PR") for h in range(0, 5000, 100)])
    new, audit = correct_table(survey, ("personas", "PR"), sheet, ["PPA03"])
    assert new.count() == 20_000 and new.filter("PPA03 = 7").count() == 50 == audit.count()
    may = marked(table, sheet.selectExpr("vivienda AS `LEVEL-1-ID`"), "LEVEL-1-ID")
    touched = may.filter("_may")
    assert 200 <= touched.count() < 300 and may.count() == 20_000
    changed, passed = children(final_plan(new), "Union")
    assert "Exchange hashpartitioning(LEVEL-1-ID" in changed and "SortMergeJoin" in changed
    assert "FileScan" in passed and "SortMergeJoin" not in passed
    assert "Exchange hashpartitioning" not in passed  # only the key filter comes there, by broadcast


def test_only_parts_with_corrections_are_written_again(spark, both, tmp_path):
    root, key = str(tmp_path / "snap"), ("personas", "PR")
    write_table(both.tables[key], root, *key, parts=8)
    folder = tmp_path / "snap" / "round=PR" / "personas"
    before = {p: p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}
    sheet = sheet_of(spark, (1, 2, "personas.ppa03", "77", 1, "PR"), (1, 9, "personas.ppa03", "78", 2, "SR"))
    work = str(tmp_path / "work")
    log = correct_snapshot(both, root, key, sheet, ["PPA03"], work)
    stored = read_table(spark, root, *key)
    expected, audit = correct_table(both, key, sheet, ["PPA03"])
    assert rows(stored, *expected.columns) == rows(expected) and rows(log) == rows(audit)
    after = {p: p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}
    kept = set(before) & set(after)
    parts = {p.parent.name for p in set(before) - kept}
    assert len(parts) == 1 and kept and all(before[p] == after[p] for p in kept)
    # The same run again: the log still has the old values.
    assert rows(correct_snapshot(both, root, key, sheet, ["PPA03"], work)) == rows(audit)
    assert rows(read_table(spark, root, *key), *expected.columns) == rows(expected)
    nothing = sheet_of(spark, (99, 2, "personas.ppa03", "77", 1, "PR"))
    assert correct_snapshot(both, root, key, nothing, ["PPA03"], str(tmp_path / "none")).count() == 0


# -- outer join, frames in a list ------------------------------------------------------------------


def test_outer_join_reads_each_table_twice(spark, conf, tmp_path):
    conf(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    frames, plain = [], []
    for n in range(6):
        data = [(k, f"{n}-{k}-{j}") for k in range(n, 9 + n) if k % (n + 2) for j in range(1 + (k == 7))] + [(None, f"{n}-null")] * (n % 3)
        spark.createDataFrame(data, f"K long, C{n} string").write.parquet(str(tmp_path / f"t{n}"))
        frames.append(spark.read.parquet(str(tmp_path / f"t{n}")))
        plain.append(data)
    joined = compare.outer_join(frames, "K")
    plan = final_plan(joined)
    assert len(re.findall("FileScan", plan)) <= 12 and plan.count("SortMergeJoin") == 5
    expected = collections.Counter()
    for key in {k for data in plain for k, _ in data if k is not None}:
        partial = [()]
        for data in plain:
            own = [c for k, c in data if k == key] or [None]
            partial = [(*p, c) for p in partial for c in own]
        expected.update((key, *p) for p in partial)
    for n, data in enumerate(plain):
        expected.update((None, *[c if m == n else None for m in range(6)]) for k, c in data if k is None)
    assert collections.Counter(map(tuple, joined.collect())) == expected
    assert joined.columns == ["K", *[f"C{n}" for n in range(6)]]


def test_outer_join_splits_a_hot_key(spark, conf):
    conf(
        autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="10KB", adaptive__skewJoin__skewedPartitionFactor="1.2",
        adaptive__advisoryPartitionSizeInBytes="20KB", shuffle__partitions="16",
    )
    hot = spark.range(0, 40_000, 1, 12).selectExpr("if(id % 3 = 0, 1L, id) AS K", "uuid() AS A")
    few = spark.range(50).selectExpr("id AS K", "id AS B")
    for tables in ([hot, few], [few, hot]):
        joined = compare.outer_join(tables, "K")
        assert "skew=true" in final_plan(joined.groupBy("B").agg(F.count("A")))
        assert joined.count() == 40_000 + 50 - few.join(hot.select("K").distinct(), "K").count()


def test_frames_in_a_list_are_told_apart_by_fingerprints(spark, conf, tmp_path):
    spark.range(2000).selectExpr("id", "nullif(id % 7, 3) AS n", "if(id = 5, -0.0D, 0.0D) AS x", "concat('t', id) AS t").write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    others = {
        "same": target.repartition(5).withColumn("x", F.lit(0.0)), "moved null": target.withColumns({"n": F.when(F.col("id") != 0, F.col("n")), "id": F.col("id")}),
        "twice": target.unionAll(target.limit(1)), "columns": target.drop("t"), "empty": target.limit(0),
    }
    found = compare.equal_frames(target, others)
    assert rows(found) == [("columns", False), ("empty", False), ("moved null", False), ("same", True), ("twice", False)]
    unequal = compare.equal_frames(target, {k: v for k, v in others.items() if k != "same"})
    assert "Exchange" not in final_plan(unequal) and "FileScan" not in final_plan(unequal)
    assert compare.equals_any(target, others) and not compare.equals_any(target, {}) and not compare.equals_any(target, {"e": others["empty"]})
    assert compare.equals_any(target.limit(0), {"e": others["empty"]})


# -- records with line breaks ----------------------------------------------------------------------

BROKEN = ['plain', 'one\nline', '"quoted"\n\n, more', None, ';,\n"', "é 🙂\n", 'x' * 200 + "\n" * 5 + "y", '"', 'a""\n""b']


@pytest.mark.parametrize("size", ["40", "97", "1000000"])
def test_texts_with_line_breaks_come_back_from_several_tasks(spark, conf, tmp_path, size):
    data = [(g, k, BROKEN[(g + k) % len(BROKEN)], None if k % 4 else "t") for g in (1, 12) for k in range(40)]
    frame = spark.createDataFrame(data, "GRUPO int, N int, TEXTO string, OTRO string")
    write_by(frame.coalesce(1), str(tmp_path / "g"), ["GRUPO"])
    write_consolidated(frame.coalesce(1), str(tmp_path / "all"))
    conf(files__maxPartitionBytes=size, files__openCostInBytes="1")
    schema = frame.select("N", "TEXTO", "OTRO").schema
    found = read_group_files(spark, str(tmp_path / "g" / "*" / "*.csv"), schema)
    assert rows(found, "GRUPO", "N", "TEXTO", "OTRO") == rows(frame)
    whole = records(spark, str(tmp_path / "all"))
    assert whole.filter("first").count() == 1 and whole.count() == len(data) + 1
    if size == "40":
        assert whole.rdd.getNumPartitions() > 10


def test_line_ends_of_other_systems_and_odd_files(spark, conf, tmp_path):
    (tmp_path / "a.csv").write_bytes('A;B\r\n1;"x\r\ny"\r\n2;z\r\n\r\n3;"open\nend'.encode())
    (tmp_path / "b.csv").write_bytes(b"A;B\n")
    (tmp_path / "c.csv").write_bytes(b"")
    conf(files__maxPartitionBytes="7", files__openCostInBytes="1")
    found = rows(read_violation_file(spark, str(tmp_path / "a.csv")))
    assert found[:2] == [("1", "x\r\ny"), ("2", "z")] and len(found) == 3
    assert rows(records(spark, str(tmp_path / "*.csv")).filter("first"), "record") == [("A;B",), ("A;B",)]


# -- running totals, repeated runs ------------------------------------------------------------------


def test_a_batch_counted_twice_adds_up_once(spark, tmp_path):
    (tmp_path / "ana.txt").write_text("a\nb\nc")
    (tmp_path / "eva.txt").write_text("")
    ledger = str(tmp_path / "ledger")

    def batch():
        counted = file_counts(spark, str(tmp_path / "*.txt"))
        return counted.select(F.regexp_replace("archivo", r"\.txt$", "").alias("analista"), "archivo", "huella", F.col("lineas").alias("conteo"))

    assert rows(add_batch(spark, ledger, batch())) == [("ana", 3)]  # Spark's readers leave out empty files
    assert rows(add_batch(spark, ledger, batch())) == [("ana", 3)]
    (tmp_path / "ana.txt").write_text("a\nb\nd")  # other lines under the same name
    (tmp_path / "luis.txt").write_text("a\nb\nc")
    assert rows(add_batch(spark, ledger, batch())) == [("ana", 6), ("luis", 3)]


def test_a_run_goes_on_after_its_last_whole_stage(spark, tables, tmp_path, monkeypatch):
    sheet = rule_sheet(spark, rule("PPA03 es vacio", "P1"), rule("P01H10 > 0", "H2"))
    sectors = spark.createDataFrame([(1, 101), (2, 100)], "GRUPO int, SECTOR int")
    places = spark.createDataFrame([(1, 2, 101, 1)], schemas.GROUPS_BY_GEOGRAPHY)
    arguments = (tables, sheet, sectors, places, *WINDOW, str(tmp_path / "run"))
    whole = full_run.run(*arguments[:-1], str(tmp_path / "other"), as_of="2023-10-04")

    def killed(*args, **kwargs):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(full_run, "merge_reports", killed)  # after two staged tables
        with pytest.raises(RuntimeError):
            full_run.run(*arguments, as_of="2023-10-04")
    (kept,) = (tmp_path / "run" / "tables").iterdir()
    assert is_whole(spark, str(kept / "violations")) and is_whole(spark, str(kept / "open_text")) and not (kept / "report").exists()
    stamps = {p: p.stat().st_mtime_ns for p in kept.rglob("*.parquet")}
    again = full_run.run(*arguments, as_of="2023-10-04")
    assert all(p.stat().st_mtime_ns == t for p, t in stamps.items())
    for name in ("violations", "open_text", "report", "deliverable"):
        assert rows(getattr(again, name)) == rows(getattr(whole, name))
    full_run.run(tables, rule_sheet(spark, rule("PPA03 es vacio", "P2")), *arguments[2:], as_of="2023-10-04")
    assert len(list((tmp_path / "run" / "tables").iterdir())) == 2  # other rules, other results


def test_a_folder_of_one_machine_is_refused_on_a_cluster():
    from types import SimpleNamespace

    from surveyqa.session import shared_place

    def session(master, **settings):
        conf = SimpleNamespace(get=lambda key, default=None: settings.get(key.replace(".", "_"), default))
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    assert shared_place(session("yarn", spark_checkpoint_dir="s3://b/c")) == "s3://b/c"
    assert shared_place(session("local[2]", spark_sql_warehouse_dir="file:/w")) == "file:/w/staged"
    assert shared_place(session("yarn", spark_sql_warehouse_dir="hdfs://w")) == "hdfs://w/staged"
    with pytest.raises(ValueError):
        shared_place(session("spark://h:1", spark_sql_warehouse_dir="file:/w"))


def test_a_stage_that_is_not_whole_is_made_anew(spark, tmp_path):
    path = str(tmp_path / "s")
    spark.range(3).write.parquet(path)
    assert staged_once(spark.range(5), path).count() == 3
    os.remove(f"{path}/_SUCCESS")
    assert staged_once(spark.range(5), path).count() == 5


# -- streams -----------------------------------------------------------------------------------------


def test_stream_comparison_counts_resent_questionnaires_once(spark, tmp_path):
    data = [(h, m, f"2023-09-{d:02d} 00:00:00", s) for h, m, d, s in (
        (1, 1, 3, "l"), (1, 2, 3, "l"), (1, 2, 3, "r"), (1, 3, 3, "r"), (2, 1, 4, "l"), (3, 5, 5, "l"), (3, 5, 5, "r"), (4, None, 5, "l"), (4, 1, 5, "r"),
        (1, 1, 3, "l"), (1, 3, 3, "r"), (5, 2, 6, "l"), (5, 3, 6, "r"), (99, 1, 28, "l"),
    )]
    frame = spark.createDataFrame(data, "h long, m int, t string, s string").withColumn("t", F.to_timestamp("t"))
    for n in range(2):
        frame.write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(frame.schema).parquet(str(tmp_path / "in"))
    found = stream_mismatch(stream.filter("s = 'l'"), stream.filter("s = 'r'"), "h", "m", "m", "t", "2 days", salts=3)
    query = found.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert rows(spark.read.schema(found.schema).parquet(str(tmp_path / "out")), "h", "member", "in_left") == [
        (1, 1, True), (1, 3, False), (5, 2, True), (5, 3, False)
    ]
