"""What keeps queries from growing faster than their tables: plans, and results where the plan is another one."""

import random

import pytest
from pyspark.sql import functions as F

from lectern.functions import text as t
from lectern.operators import structure
from lectern.plans.catalogue import QUERIES
from lectern.sources import tsv


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_digests_are_not_broadcast_by_an_estimate(spark):
    from lectern.operators import audit

    expected = spark.sql("SELECT * FROM VALUES ('a', 3), ('b', 0) AS t(source_sha256, n_pages)")
    evidence = spark.sql("SELECT * FROM VALUES ('a', 1L, 'a', 1L, 'r'), ('a', 2L, 'b', 2L, 'r') AS t(source_sha256, page, says_sha256, says_page, raw_sha256)")
    payloads = spark.sql("SELECT * FROM VALUES ('a', 1L, 'r'), ('b', 1L, 'r') AS t(source_sha256, page, sha256)")
    out = audit.ocr_evidence(expected, evidence, payloads)
    assert "Broadcast" not in plan(out)
    assert {(r.page, r.status) for r in out.collect()} == {(1, "OK"), (2, "OCR_PROVENANCE_MISMATCH"), (3, "MISSING_OCR_PAGE")}


STRUCTURE = {"procedures": 3, "procedure_steps": 3, "procedure_phases": 3, "sequence_issues": 3, "repair_numbers": 5, "page_class": 3, "page_class_histogram": 4}


@pytest.mark.parametrize("name", STRUCTURE)
def test_lines_are_dealt_once(spark, sf_dir, name):
    """Order lines and parts by part, then by page; distinct, sorted and summed-up rows of their own beyond that."""
    assert plan(QUERIES[name](spark, sf_dir)).count("Exchange ") <= STRUCTURE[name]


def test_segments_against_a_plain_reading(spark):
    """Random lines of titles, anchors, phases, steps and others, in body regions and others, against loops over each region."""
    rng = random.Random(5)
    said = ["COOLING FAN", "Service Repair No. 12.25.01", "Remove", "Refit:", "1. do", "2. do", "3. do", "- item", "and then", "", "  ", "4. Service repair no 1.2", "TOP  GEAR"]
    rows = [("s", p, region, k, rng.choice(said), float(rng.randint(50, 99))) for p in range(40) for region in ("left", "header", "body") for k in range(rng.randint(1, 30))]
    want, classes = [], {}
    for p in range(40):
        n = 0
        for region in ("left", "body"):
            own = [" ".join(r[4].split()) for r in rows if r[1:3] == (p, region)]
            anchors = [k for k, x in enumerate(own) if "epair" in x]
            title = {a: max([k for k in range(max(0, a - 4), a) if own[k].isupper()], default=None) for a in anchors}
            for i, a in enumerate(anchors):
                stop = len(own) if i + 1 == len(anchors) else anchors[i + 1]
                if i + 1 < len(anchors) and title[stop] is not None and title[stop] > a:
                    stop = title[stop]
                numbers, phase, last, bad, unphased = [], 0, None, False, 0
                for x in own[a + 1 : stop]:
                    if x in ("Remove", "Refit:"):
                        phase, last = phase + 1, None
                    elif x[:1].isdigit():
                        number = int(x[0])
                        bad |= phase > 0 and last is not None and number != last + 1
                        unphased += phase == 0
                        last = number
                        numbers.append(number)
                if len(numbers) >= 2 and phase:
                    want.append((p, region, a, None if title[a] is None else own[title[a]], numbers, phase, "phase_sequence_issue" if bad else "unphased_steps_present" if unphased else "contiguous_by_phase"))
                    n += 1
        classes[p] = n
    lines = spark.createDataFrame(rows, "source string, page long, region string, line_index int, text string, mean_confidence double")
    got = [(r.page, r.region, r.anchor, r.title, r.step_numbers, r.n_phases, r.sequence_status) for r in structure.procedures(lines).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want)) and len(want) > 20
    assert {r.page: r.n_procedures for r in structure.page_class(lines).collect()} == classes


def test_long_runs_of_marks_are_searched_once(spark):
    """Lines of 300,000 marks that no heading ends with; before, a search from each of them to the end of the run."""
    import time

    lines = spark.createDataFrame([(k, "Fan " + "§" * 300_000 + "x") for k in range(4)] + [(9, "** FAN ~~ (2) ~§~")], "k int, line string")
    began = time.time()
    got = {r.k: r.h for r in lines.select("k", t.clean_heading(F.col("line")).alias("h")).collect()}
    assert got[9] == "FAN ~~ (2)" and len(got[0]) == 300_005 and time.time() - began < 20


def test_word_tables_are_read_once(spark, sf_dir):
    """Files of all kinds of lines and terminators, against a plain reading; and each query scans its files once."""
    head = "\t".join(tsv.HEADER)
    word = lambda conf="90", text="gear", left="10": f"5\t1\t2\t\t3\t4\t{left}\t20\t30\t40\t{conf}\t{text}"
    files = [
        ("", []), (None, []), (head, []), (head + "\n", []), ("a\tb\r\n" + word(), []), ("\n" + word(), []), (head + "\r" + word() + "\x85" + word("-1", "a\tb") + "\r\n", []),
        (head + "\n" + "\n".join([word(""), word("bad"), word("9e1", " x "), word(left="1x"), word(text="  "), "5\t1", word().replace("5", "4", 1), word(text='"q')]) + "\n\n", []), ("\n", []), (head + "x\n" + word(left=" 7 "), []),
    ]
    frame = spark.createDataFrame([("s", k, x) for k, (x, _) in enumerate(files)], "source string, page int, tsv string")
    got = {(r.page, r.code, r.line_number) for r in tsv.warnings(frame).collect()}
    assert got == {
        (0, "EMPTY_TSV", 0), (1, "EMPTY_TSV", 0), (4, "UNEXPECTED_TSV_HEADER", 1), (5, "UNEXPECTED_TSV_HEADER", 1), (8, "UNEXPECTED_TSV_HEADER", 1), (9, "UNEXPECTED_TSV_HEADER", 1),
        (7, "INVALID_TSV_WORD_ROW", 3), (7, "INVALID_TSV_WORD_ROW", 5), (7, "MALFORMED_TSV_ROW", 7),
    }
    said = sorted((r.page, r.par_num, r.left, r.confidence, r.text) for r in tsv.words(frame).select("page", "par_num", "left", F.coalesce("confidence", F.lit(-1.0)).alias("confidence"), "text").collect())
    assert said == sorted([(4, 0, 10, 90.0, "gear"), (5, 0, 10, 90.0, "gear"), (6, 0, 10, 90.0, "gear"), (6, 0, 10, -1.0, "a\tb"), (7, 0, 10, -1.0, "gear"), (7, 0, 10, 90.0, "x"), (7, 0, 10, 90.0, '"q'), (9, 0, 7, 90.0, "gear")])
    assert plan(QUERIES["tsv_warnings"](spark, sf_dir)).count("FileScan") == 1
    assert plan(QUERIES["tsv_words"](spark, sf_dir)).count("split(line") == 1


@pytest.mark.parametrize("name", ["ocr_lines", "page_text", "region_word_counts", "gutter_candidates", "best_gutters", "page_layout", "native_column_signal"])
def test_words_are_not_shuffled(spark, sf_dir, name):
    """Documents are dealt by page before they become words: every exchange is of documents."""
    dealt = [x for x in plan(QUERIES[name](spark, sf_dir)).splitlines() if " Exchange " in x]
    assert dealt and all("REPARTITION_BY_NUM" in x for x in dealt)


def test_context_reads_keys_only(spark, sf_dir):
    """Chapters of pages need no lines: one scan, no window, no join."""
    from lectern.plans import evidence

    said = plan(evidence._context(spark, sf_dir))
    assert said.count("FileScan") == 1 and "Window" not in said and "Join" not in said
