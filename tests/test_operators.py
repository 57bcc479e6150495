"""Behaviours of single operators on small rows of our own."""

import base64
import random
import sqlite3
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from lectern.functions import text as t
from lectern.operators import corrections, fragments, hierarchy, identity, integrity, layout, ocr, packs, search, structure
from lectern.sources import decoders, files, sqlite, tsv

WORD = "source string, page long, block_num int, par_num int, line_num int, word_num int, `left` int, top int, width int, height int, text string, confidence double"


def words(spark, rows):
    return spark.createDataFrame([("s", p, 1, 1, 1, k, k * 10, 100, 9, 9, w, c) for k, (p, w, c) in enumerate(rows)], WORD)


def lines(spark, rows, page=1):
    full = [("s", r[3] if len(r) > 3 else page, r[0], k, r[1], float(r[2]) if len(r) > 2 and r[2] is not None else None) for k, r in enumerate(rows)]
    return spark.createDataFrame(full, "source string, page long, region string, line_index int, text string, mean_confidence double")


def one(spark, expression, *values):
    names = "abcdef"[: len(values)]
    kinds = {str: "string", int: "bigint", float: "double", bytes: "binary", list: "array<int>"}
    df = spark.createDataFrame([values], ", ".join(f"{n} {kinds[type(v)]}" for n, v in zip(names, values)))
    return df.select(expression.alias("r")).first().r


@pytest.mark.parametrize(
    ("call", "value", "want"),
    [
        (t.spaced, " a  – b—c ", "a - b-c"), (t.letters, "a1-é ß", "aéß"), (t.clean_heading, "** THE ENGINE. |", "THE ENGINE"), (t.token, '("Gear-Box),', "gear-box"),
        (t.phase_source, " Refitting: ", "refitting"), (t.phase_source, "Refit it", None), (t.repair_number, "x SERVICE  repair No. 12.25.01 y", "12.25.01"), (t.repair_number, "Repair No 12", None),
        (t.step_number, "12.5 V", 12), (t.step_number, "1234. x", None), (t.step_body, "3.  Do  it ", "Do it"), (t.is_bullet, "o  item", True), (t.is_bullet, "of item", False), (t.bullet_body, "• x y", "x y"),
        (t.is_title, "COOLING FAN", True), (t.is_title, "Cooling fan", False), (t.is_title, "REPAIRS", False), (t.is_title, "FAN", False), (t.is_heading, "Cooling FAN UNIT 3", False), (t.is_heading, "COOLING Fan UNIT", True),
        (t.trailing_page, "Fan . . 12", 12), (t.trailing_page, "Fan 1234", None), (t.is_safe_path, "a/b.png", True), (t.is_safe_path, "a/../b", False), (t.is_safe_path, "a\\b", True), (t.is_safe_path, "C:x", False),
        (t.is_safe_path, "/a", False), (t.is_safe_path, "", False), (t.is_allowed_member, "ocr/page-12.tsv.gz", True), (t.is_allowed_member, "ocr/page-x.tsv.gz", False), (t.ascii_lower, "ABÉ", "abÉ"),
        (t.normal_key, "Doc 1-ENG", "doc1eng"), (t.file_stem, "a/b.c.pdf", "b.c"), (t.file_stem, ".x", ".x"), (hierarchy.slug, "Été à l'ÎLE!", "ete-a-l-ile"), (hierarchy.slug, "漢", "unresolved"),
        (t.git_blob_sha1, b"hello\n", "ce013625030ba8dba906f756967f9e9ca394464a"), (t.finite, "nan", None), (t.finite, "1.5", 1.5), (t.finite, "x", None), (t.safe_filename, "a b/c", "a_b_c"),
        (t.is_sha256, "A" * 64, True), (t.is_sha256, "g" * 64, False), (files.ocr_language, "akENGine.pdf", "eng"),
    ],
)
def test_scalar_functions(spark, call, value, want):
    assert one(spark, call(F.col("a")), value) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [("D:1.2", ["D:1.2"]), ("D:1.1-1.3, 2.1", ["D:1.1", "D:1.2", "D:1.3", "D:2.1"]), ("D:1.3-1.1", ["D:1.3-1.1"]), ("D:1.1-2.1", ["D:1.1-2.1"]), ("D:1.1-1.14", ["D:1.1-1.14"]), ("D:1.1,1.1", ["D:1.1"]), ("see 3", ["see 3"]), ("  ", [])],
)
def test_expanded_references(spark, text, want):
    assert one(spark, t.expanded_references(F.col("a")), text) == want


def test_unknown_language_is_an_error(spark):
    with pytest.raises(Exception, match="no OCR language"):
        one(spark, files.ocr_language(F.col("a")), "doc.pdf")


# words

def test_confidence_ignores_unknown_and_punctuation(spark):
    df = words(spark, [(1, "gear", 90.0), (1, "...", 10.0), (1, "box", None), (2, "--", 20.0)])
    plain = {r.page: r for r in ocr.confidence_summary(df).collect()}
    assert (plain[1].n_words, plain[1].mean_confidence, plain[1].below_50) == (2, 50.0, 1)
    semantic = {r.page: r for r in ocr.semantic_confidence_summary(df).collect()}
    assert (semantic[1].n_words, semantic[1].below_50_ratio) == (1, 0.0)
    assert (semantic[2].n_words, semantic[2].mean_confidence, semantic[2].below_50_ratio) == (0, None, None)


def test_one_doubtful_word_stays_local_and_dense_ones_do_not(spark):
    df = words(spark, [(1, "good", 95.0)] * 10 + [(1, "gcod", 40.0)] + [(2, "good", 99.0)] * 17 + [(2, "gcod", 40.0)] * 3 + [(3, "...", 99.0)] + [(4, "x" * 121, 99.0)])
    got = {r.page: r.reasons for r in ocr.page_review_refined(df).collect()}
    assert got == {1: [], 2: ["dense_semantic_ocr_words_below_50"], 3: ["no_semantic_ocr_words"], 4: ["suspiciously_long_ocr_token"]}
    first = {r.page: r.reasons for r in ocr.page_review_first_pass(df).collect()}
    assert first[1] == ["contains_ocr_word_below_50"]
    gates = {r.page: r.gate for r in ocr.translation_gate(df).collect()}
    assert gates[1] == "BLOCKED_OCR_REVIEW" and gates[3] == "SOURCE_TEXT_READY"


def test_spelling_proposals_are_kept_for_review(spark):
    df = words(spark, [(1, "Gearbox", 97.0), (2, "gearbox", 98.0), (3, "Gearbox,", 95.0), (3, "gearbax", 41.0), (3, "brake", 99.0), (3, "brake", 99.0), (3, "braze", 99.0), (3, "braze", 99.0), (4, "brabe", 30.0), (4, "gearbox", 30.0), (4, "xearbox", 30.0)])
    lexicon = {r.token: r for r in ocr.lexicon(df).collect()}
    assert lexicon["gearbox"].occurrences == 3 and lexicon["gearbox"].canonical == "Gearbox"
    got = {r.original: r for r in ocr.spelling_candidates(df, ocr.lexicon(df)).collect()}
    assert set(got) == {"gearbax", "brabe"}
    assert got["gearbax"].status == "STRONG_CANDIDATE_REVIEW_REQUIRED" and not got["gearbax"].applied
    assert got["brabe"].status == "REVIEW_REQUIRED" and [p.known for p in got["brabe"].proposals] == ["brake", "braze"]


def test_spelling_join_finds_all_pairs_within_the_distance(spark):
    rng = random.Random(1)
    known = ["".join(rng.choice("abc") for _ in range(rng.randint(3, 11))) for _ in range(60)]
    asked = ["".join(rng.choice("abc") for _ in range(rng.randint(4, 10))) for _ in range(80)]
    df = words(spark, [(1, w, 99.0) for w in known for _ in range(2)] + [(2, w, 10.0) for w in asked])
    got = {(r.token, r.known) for r in ocr.spelling_matches(df, ocr.lexicon(df)).collect()}

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            new = [i + 1]
            for j, y in enumerate(b):
                new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
            row = new
        return row[-1]

    want = {(a, b) for a in asked for b in known if a not in known and a[0] == b[0] and distance(a, b) <= (1 if len(a) <= 7 else 2)}
    assert got == want and want


def test_long_tokens_meet_by_pieces(spark):
    """All pairs within distance 2 of tokens of 11 to 40 letters and one of 10,000, against a plain comparison."""
    import random

    rng = random.Random(3)

    def edit(word):
        for _ in range(rng.randint(0, 2)):
            at = rng.randrange(1, len(word))
            word = rng.choice([word[:at] + word[at + 1 :], word[:at] + "q" + word[at:], word[:at] + "z" + word[at + 1 :]])
        return word

    base = ["t" + "".join(rng.choice("eha") for _ in range(n)) for n in (10, 11, 12, 13, 14, 17, 25, 39, 9999) for _ in range(3)]
    known = sorted(set(base))
    doubtful = sorted({edit(w) for w in base for _ in range(3)} - set(known))
    lex = spark.createDataFrame([("s", w, w, 5, 99.0) for w in known], "source string, token string, canonical string, occurrences long, mean_confidence double")
    words = spark.createDataFrame([("s", 1, w, 10.0) for w in doubtful], "source string, page int, text string, confidence double")

    def near(a, b):
        if abs(len(a) - len(b)) > 2:
            return 9
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j in range(1, len(b) + 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != b[j - 1])) if abs(i - j) <= 3 else 99)
            row = new
        return row[-1]

    short = [w for w in doubtful if len(w) < 100]
    want = {(a, b, d) for a in short for b in known if len(b) < 100 and (d := near(a, b)) <= 2}
    got = {(r.token, r.known, r.distance) for r in ocr.spelling_matches(words, lex).collect()}
    assert {x for x in got if len(x[0]) < 100} == want and {x[0] for x in got if len(x[0]) > 100} == {w for w in doubtful if len(w) > 100}


def test_page_text_breaks_between_blocks(spark):
    rows = [("s", 1, 1, 1, 1, 2, 0, 0, 1, 1, "b", 1.0), ("s", 1, 1, 1, 1, 1, 5, 0, 1, 1, "a", 1.0), ("s", 1, 1, 1, 2, 1, 0, 0, 1, 1, "c", 1.0), ("s", 1, 2, 1, 1, 1, 0, 0, 1, 1, "d", 1.0)]
    assert ocr.page_text(spark.createDataFrame(rows, WORD)).first().page_text == "a b\nc\n\nd"


# layout

def boxes(spark, places):
    rows = [("s", 1, y, 1, y, k, x, 300 + 40 * y, w, 30, f"w{k}", 90.0, 1000, 2000) for k, (x, y, w) in enumerate(places)]
    return layout.regions(spark.createDataFrame(rows, WORD + ", page_width int, page_height int"))


def test_two_columns_are_a_candidate_only(spark):
    df = boxes(spark, [(x, y, 90) for y in range(6) for x in (50, 200, 350, 600, 750)])
    gutter = layout.best_gutter(layout.gutter_candidates(df))
    g = gutter.first()
    assert g.two_columns and (g.left_words, g.right_words, g.crossing_words, g.x, g.gap_px) == (18, 12, 0, 440, 160)
    page = layout.page_layout(df, gutter).first()
    assert (page.layout_type, page.status, page.left_words, page.right_words) == ("possible_two_columns", "REVIEW_REQUIRED", 18, 12)
    assert page.candidate_text.split("\n")[0] == "w0 w1 w2"


def test_one_flow_has_no_gutter(spark):
    df = boxes(spark, [(50 + 90 * k, y, 95) for y in range(6) for k in range(9)])
    gutter = layout.best_gutter(layout.gutter_candidates(df))
    assert not gutter.first().two_columns
    assert layout.page_layout(df, gutter).first().status == "CANDIDATE_ONLY"
    assert layout.gutter_candidates(boxes(spark, [(50, 1, 10)] * 19)).count() == 0


# structure

PROCEDURE = [("left", "FAN UNIT"), ("left", "Service Repair No. 26.25.01"), ("left", "Remove"), ("left", "1. Drain it."), ("left", "and wait"), ("left", "• gently"), ("left", "2. Lift."), ("left", "Refitting"), ("left", "1. Lower."), ("left", "2. Fill.")]


def test_restart_in_each_phase_is_clean(spark):
    p = structure.procedures(lines(spark, PROCEDURE)).first()
    assert (p.repair_number, p.title, p.n_steps, p.n_phases, p.sequence_status, p.review_reasons) == ("26.25.01", "FAN UNIT", 4, 2, "contiguous_by_phase", [])
    phases = {r.phase_no: (r.phase, r.phase_source, r.status) for r in structure.phases(lines(spark, PROCEDURE)).collect()}
    assert phases == {1: ("remove", "remove", "contiguous"), 2: ("refit", "refitting", "contiguous")}
    steps = {(r.phase_no, r.number): (r.text, r.subitems) for r in structure.steps(lines(spark, PROCEDURE)).collect()}
    assert steps[1, 1] == ("Drain it. and wait", "gently")


def test_gaps_lists_and_typos(spark):
    gap = [("left", "Service Repair No. 1.2"), ("left", "Remove"), ("left", "1. a"), ("left", "3. b")]
    p = structure.procedures(lines(spark, gap)).first()
    assert p.sequence_status == "phase_sequence_issue" and p.review_reasons == ["missing_title", "phase_step_sequence_not_contiguous"]
    assert structure.procedures(lines(spark, [("left", "Service Repair No. 1.2"), ("left", "1. a"), ("left", "2. b")])).count() == 0
    assert structure.procedures(lines(spark, [("left", "Service Repair No. 1.2"), ("left", "Dismantie"), ("left", "1. a"), ("left", "2. b")])).count() == 0
    low = [("left", "TITLE HERE"), ("left", "Service Repair No. 1.2"), ("left", "0. early"), ("left", "Remove"), ("left", "1. a", 60), ("left", "2. b")]
    p = structure.procedures(lines(spark, low)).first()
    assert p.review_reasons == ["step_without_phase", "low_ocr_confidence_in_step"] and p.sequence_status == "unphased_steps_present"


def test_next_title_ends_a_procedure(spark):
    rows = PROCEDURE + [("left", "NEXT UNIT"), ("left", "Service Repair No. 26.25.02"), ("left", "Adjust"), ("left", "1. x"), ("left", "2. y")] + [("right", r[1]) for r in PROCEDURE]
    got = sorted((r.region, r.repair_number, r.title, r.n_steps) for r in structure.procedures(lines(spark, rows)).collect())
    assert got == [("left", "26.25.01", "FAN UNIT", 4), ("left", "26.25.02", "NEXT UNIT", 2), ("right", "26.25.01", "FAN UNIT", 4)]


def test_page_classes(spark):
    contents = [("body", "Contents:")] + [("body", f"Entry {k}") for k in range(7)]
    rows = [(r, x, None, 1) for r, x in contents] + [(r, x, None, 2) for r, x in contents[:5]] + [("body", f"{k}. part", None, 3) for k in range(5)] + [("body", "INTRODUCTION", None, 4)] + [(r, x, None, 5) for r, x in PROCEDURE] + [("body", "the contents are", None, 6)]
    got = {r.page: r.page_class for r in structure.page_class(lines(spark, rows)).collect()}
    assert got == {1: "contents_page_candidate", 2: "unclassified_candidate", 3: "numbered_component_or_reference_list_candidate", 4: "front_matter_or_narrative_candidate", 5: "repair_procedure_page", 6: "unclassified_candidate"}


def test_row_order_does_not_matter(spark):
    df = lines(spark, PROCEDURE * 2)
    shuffled = df.orderBy(F.rand(3)).repartition(5)
    assert structure.procedures(df).collect() == structure.procedures(shuffled).collect()


# hierarchy and fragments

def test_chapters_merge_equal_titles_only(spark):
    anchors = spark.createDataFrame([("s", 3, "Brakes", "CANDIDATE_ONLY"), ("s", 5, " BRAKES ", "REVIEW_REQUIRED"), ("s", 8, None, "REVIEW_REQUIRED"), ("s", 9, None, "REVIEW_REQUIRED"), ("s", 12, "Body", "CANDIDATE_ONLY")], "source string, page long, title string, status string")
    pages = spark.range(1, 16).selectExpr("'s' AS source", "id AS page")
    chapters = hierarchy.chapters(anchors, pages)
    got = [(r.chapter_id, r.start_page, r.end_page, r.n_anchors, r.status) for r in chapters.orderBy("start_page").collect()]
    assert got == [("chapter-0003-brakes", 3, 7, 2, "REVIEW_REQUIRED"), ("chapter-0008-unresolved", 8, 8, 1, "REVIEW_REQUIRED"), ("chapter-0009-unresolved", 9, 11, 1, "REVIEW_REQUIRED"), ("chapter-0012-body", 12, 15, 1, "CANDIDATE_ONLY")]
    context = {r.page: r.chapter_id for r in hierarchy.page_context(pages, chapters).collect()}
    assert context[2] is None and context[7] == "chapter-0003-brakes" and context[15] == "chapter-0012-body"


def test_title_comes_from_a_following_header(spark):
    anchors = spark.createDataFrame([("s", 1), ("s", 10), ("s", 20)], "source string, page long")
    heads = spark.createDataFrame([("s", 3, "header", 1, "FUEL SYSTEM"), ("s", 10, "header", 5, "- BRAKES -"), ("s", 10, "header", 7, "LATER ONE"), ("s", 25, "header", 1, "TOO FAR"), ("s", 21, "body", 1, "NOT A HEADER")], "source string, page long, region string, seq long, text string")
    got = {r.page: (r.title, r.method, r.status) for r in hierarchy.anchor_titles(anchors, heads).collect()}
    assert got == {1: ("FUEL SYSTEM", "nearby_following_page_header", "REVIEW_REQUIRED"), 10: ("BRAKES", "contents_page_header", "CANDIDATE_ONLY"), 20: (None, "unresolved", "REVIEW_REQUIRED")}


def test_fragments_chain_within_a_chapter(spark):
    numbers = lambda region, page, a, b: [(region, f"{k}. x", None, page) for k in range(a, b + 1)]
    rows = [(r, x, None, 1) for r, x in PROCEDURE] + numbers("left", 2, 3, 4) + numbers("left", 3, 5, 6) + numbers("left", 4, 7, 8) + numbers("left", 5, 9, 10) + numbers("right", 2, 20, 22) + numbers("left", 9, 1, 3) + [("left", "Refit", None, 20)] + numbers("left", 20, 1, 2)
    df = lines(spark, rows)
    context = spark.range(1, 30).selectExpr("'s' AS source", "id AS page", "CASE WHEN id < 5 THEN 'a' ELSE 'b' END AS chapter_id")
    judged = fragments.fragments_of(df, context)
    got = {(r.page, r.region): (r.accepted, r.rejection) for r in judged.collect()}
    assert [got[p, "left"][0] for p in (2, 3, 4, 5, 20)] == [True, True, True, False, True]
    assert got[5, "left"][1] == "numbering_only_without_same_resolved_chapter" and got[2, "right"][1] == "numbering_only_without_adjacent_procedure_progression"
    assert (9, "left") not in got and (1, "left") not in got
    evidence = {r.page: r.evidence for r in judged.where("accepted").collect()}
    assert evidence[2][-1] == "continues_previous_page_procedure_numbering" and evidence[3][-1] == "continues_previous_page_fragment_numbering"
    assert sorted(r.to_page for r in fragments.link_candidates(judged).collect()) == [2, 3, 4, 20]


# identity, integrity, packs, search, corrections

def test_page_coverage_verdicts(spark):
    expected = spark.createDataFrame([("a", 2), ("b", 2), ("c", 2), ("d", None), ("e", 2), ("f", 0)], "revision string, n_pages long")
    pages = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", 1), ("c", 1), ("c", 2), ("c", 2), ("d", 1)], "revision string, page long")
    got = {r.revision: r.coverage for r in identity.page_coverage(expected, pages).collect()}
    assert got == {"a": "COMPLETE_PAGE_SET", "b": "INCOMPLETE_PAGE_SET", "c": "INCOMPLETE_PAGE_SET", "d": "UNVERIFIED", "e": "UNVERIFIED", "f": "UNVERIFIED"}


def test_source_identity_needs_exactly_one_key(spark):
    sha = ["ab" * 32, "cd" * 32, "ef" * 32, "12" * 32, "ab" * 32]
    sources = spark.createDataFrame([("x/one.pdf", sha[0], 0), ("x/two.pdf", sha[1], 1), ("x/three.pdf", sha[2], 2), ("x/four.pdf", sha[3], 3), ("x/copy.pdf", sha[4], 4)], "path string, sha256 string, seq long")
    keys = spark.createDataFrame([("DOC_PDFSHA256" + sha[0][:16].upper(), 0), ("Two", 1), ("DOC_PDFSHA256" + sha[1][:20], 2), ("meta", 3), ("DOC_PDFSHA256abc", 4)], "document_key string, seq long")
    meta = spark.createDataFrame([("meta", "filename", "THREE", 0), ("meta", "hash", sha[2], 1), ("gone", "hash", sha[3], 2)], "document_key string, kind string, value string, seq long")
    got = {r.path: (r.document_key, r.proof, r.state) for r in identity.source_pack_identity(sources, keys, meta).collect()}
    assert got["x/one.pdf"][1:] == ("SHA256_PREFIX_OF_ORIGINAL_PDF", "matched") and got["x/copy.pdf"][2] == "ambiguous_source_id"
    assert got["x/two.pdf"] == (None, "AMBIGUOUS", "source_id_not_proven")
    assert got["x/three.pdf"] == ("meta", "DOCUMENT_METADATA_EXACT_SHA256", "matched") and got["x/four.pdf"][1] == "UNMATCHED"


def test_gates_are_monotone(spark):
    schema = "severity string, status string, k int"
    calm = [("critical", "resolved", 1), ("blocking", "resolved", 1)]
    assert not integrity.review_gate(spark.createDataFrame(calm, schema), ["k"]).first().publication_blocked
    assert integrity.review_gate(spark.createDataFrame(calm + [("minor", "pending", 1)], schema), ["k"]).first().publication_blocked
    find = lambda rows: integrity.publication_state(integrity.findings_of(spark, rows)).first()
    assert [find(r).state for r in ([("x", "unproven")], [("x", "unproven"), ("b", "blocker")], [])] == ["REVIEW_REQUIRED", "BLOCKED", "TECHNICALLY_VERIFIED"]
    assert find([("b", "blocker"), ("a", "blocker"), ("b", "blocker")]).blockers == ["a", "b"]


def test_key_checks(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    child = spark.createDataFrame([(1,), (3,), (None,)], "p int")
    assert integrity.foreign_key_violations(child, parent, "p", "id", "x").first().violations == 1
    assert integrity.key_violations(spark.createDataFrame([(1,), (1,), (2,)], "id int"), ["id"], "x").first().violations == 1
    assert integrity.null_violations(child, ["p"], "x").first().violations == 1


def test_search_takes_wildcards_as_letters_and_keeps_accents_apart(spark):
    df = spark.createDataFrame([(1, "100% done"), (2, "100 x done"), (3, "É"), (4, "é"), (5, "a_B")], "id long, body string")
    base = [search.Searchable("notes", df, ("title", "body"), ("id", "body", "none"), ("id",))]
    ids = lambda term, limit=20: [r.fields["id"] for r in search.search(base, term, limit).collect()]
    assert ids("100%") == ["1"] and ids("é") == ["4"] and ids("A_b") == ["5"] and ids("  ") == [] and ids("done", 1) == ["1"] and ids("done", 0) == ["1"]


def test_combined_search_alternates(spark):
    frame = lambda name, n: search.matches([search.Searchable(name, spark.range(n).selectExpr("id", "'hit' AS body"), ("body",), ("id",), ("id",))], "hit")
    scopes = [r.scope_rank for r in search.combined(frame("old", 5), frame("new", 2), 6).collect()]
    assert scopes == [0, 1, 0, 1, 0, 0]


def test_staging_is_idempotent_and_refuses_conflicts(spark):
    sha = ["a" * 64, "b" * 64, "c" * 64]
    current = spark.createDataFrame([(sha[0], "p1"), (sha[1], "p1")], "source_sha256 string, pack_sha256 string")
    incoming = spark.createDataFrame([(sha[0], "p1", 1), (sha[1], "p2", 1), (sha[2], "p3", 1), ("x", "p", 1), (sha[2], "p4", packs.LARGEST_MEMBER + 1)], "source_sha256 string, pack_sha256 string, largest_member long")
    assert sorted(r.action for r in packs.staged(current, incoming).collect()) == ["ALREADY_PRESENT", "CONFLICTING_PACK_REVISION", "INVALID_SHA256", "MEMBER_TOO_LARGE", "STAGED"]


def test_corrections_change_only_what_they_name(spark):
    schema = "lot string, sql string"
    make = lambda n, level="verifie_constructeur": "\n".join(x for k in range(n) for x in (f"INSERT OR REPLACE INTO source_reference_correction('C{k}','F{k}','D:39.1','D:39.2','it''s','{level}','');", f"INSERT OR IGNORE INTO illustration_link('F{k}','REF:D:39.2','source','');"))
    lots = spark.createDataFrame([("ok", make(3)), ("few", make(2)), ("draft", make(3, "draft")), ("none", "")], schema)
    assert {r.lot: r.status for r in corrections.lot_status(lots).collect()} == {"ok": "OK", "few": "CORRECTION_COUNT_MISMATCH", "draft": "INVALID_CORRECTION_LINKS", "none": "CORRECTION_COUNT_MISMATCH"}
    fixes, links = corrections.parsed(lots.where("lot = 'ok'"))
    assert fixes.first().reason == "it's"
    knowledge = spark.createDataFrame([("KNOW-F0", "D:39.1", "part 39.1"), ("KNOW-F1", "D:1.1", "part 39.1"), ("KNOW-F2", "D:39.1", "part 4"), ("other", "D:39.1", "39.1")], "knowledge_key string, image_ref string, source_section string")
    new, history = corrections.applied(knowledge, fixes, links)
    assert sorted(map(tuple, new.collect())) == [("KNOW-F0", "D:39.2", "part 39.2"), ("KNOW-F1", "D:1.1", "part 39.1"), ("KNOW-F2", "D:39.1", "part 4"), ("other", "D:39.1", "39.1")]
    assert history.count() == 1
    assert [r.seq for r in corrections.inspected(lots.where("lot = 'ok'"), ["f1"]).orderBy("seq").collect()] == [2, 3]


# sources

def test_a_lone_quote_swallows_no_line(spark):
    row = lambda *f: "\t".join(map(str, f))
    text = "\n".join([row(*tsv.HEADER), row(5, 1, 1, 1, 1, 1, 0, 0, 1, 1, 96.5, '"'), row(5, 1, 1, 1, 1, 2, 0, 0, 1, 1, -1, "b"), "5\t1\t1", row(5, 1, "", 1, 1, "x", 0, 0, 1, 1, 1, "c"), row(5, 1, 1, 1, 1, 3, 0, 0, 1, 1, "", "d\te"), row(4, 1, 1, 1, 1, 3, 0, 0, 1, 1, 1, "z"), row(5, 1, 1, 1, 1, 4, 0, 0, 1, 1, "-1.0", "f")])
    df = spark.createDataFrame([("s", 1, text), ("s", 2, ""), ("s", 3, "a\tb\n" + row(5, 1, 1, 1, 1, 1, 0, 0, 1, 1, 9, " "))], "source string, page int, tsv string")
    assert [(r.text, r.confidence) for r in tsv.words(df).orderBy("word_num").collect()] == [('"', 96.5), ("b", None), ("d\te", None), ("f", -1.0)]
    assert sorted((r.page, r.code, r.line_number) for r in tsv.warnings(df).collect()) == [(1, "INVALID_TSV_WORD_ROW", 5), (1, "MALFORMED_TSV_ROW", 4), (2, "EMPTY_TSV", 0), (3, "UNEXPECTED_TSV_HEADER", 1)]


def test_packed_lots(spark):
    data = "é;".encode()
    pack = lambda n, d=data: struct.pack(">I", n) + zlib.compress(d)
    rows = [("a", pack(len(data))), ("b", pack(len(data) + 1)), ("c", b"xy"), ("d", struct.pack(">I", 3) + b"junk"), ("e", None)]
    text = spark.createDataFrame([(k, base64.b64encode(v).decode() if v is not None else None) for k, v in rows], "lot string, packed string")
    raw = spark.createDataFrame(rows, "lot string, packed binary")
    for df in (text, raw):
        got = {r.lot: (r.sql, r.error) for r in files.unpacked_lots(df).collect()}
        assert got == {"a": ("é;", None), "b": (None, "LENGTH_MISMATCH"), "c": (None, "TOO_SHORT"), "d": (None, "error"), "e": (None, "TOO_SHORT")}


def test_previews_of_a_long_document(spark):
    got = one(spark, files.preview_pages(F.col("a").cast("int")), 482)
    assert got == [*range(1, 13), 48, 100, 120, 200, 241, 300, 362, 400, 434, 482]
    assert one(spark, files.preview_pages(F.col("a").cast("int")), 3) == [1, 2, 3]


def test_file_scan_and_changes(spark, tmp_path):
    (tmp_path / "d").mkdir()
    for name in ("a.pdf", "d/b.PDF", "c.txt", "d/d.pdf"):
        (tmp_path / name).write_bytes(name.encode())
    found = files.scan(spark, str(tmp_path)).withColumn("path", F.regexp_extract("path", r"([^/]+)$", 1))
    assert sorted(r.path for r in found.collect()) == ["a.pdf", "b.PDF", "d.pdf"]
    changes = spark.createDataFrame([("a.pdf", "M"), ("d.pdf", "D")], "path string, status string")
    names = lambda **k: sorted(r.path for r in files.changed_only(found, changes, **k).collect())
    assert names(before="a" * 40) == ["a.pdf"] and len(names(before="0" * 40)) == 3 and len(names(event="schedule", before="zz")) == 3
    with pytest.raises(ValueError):
        names(before="zz")


def test_sqlite_is_read_and_never_made(spark, tmp_path):
    path = str(tmp_path / "x.sqlite")
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE t(a INTEGER, b TEXT, c REAL, d BLOB)")
        db.execute("INSERT INTO t VALUES (1, 'x', 1.5, x'00ff'), (NULL, NULL, NULL, NULL)")
    db.close()
    assert sqlite.table_names(path) == ["t"]
    got = sqlite.read(spark, [path], "t").orderBy("a").collect()
    assert [tuple(r) for r in got] == [(None, None, None, None), (1, "x", 1.5, bytearray(b"\x00\xff"))]
    with pytest.raises(FileNotFoundError):
        sqlite.table_names(str(tmp_path / "none.sqlite"))
    assert not (tmp_path / "none.sqlite").exists()


def test_verified_write_leaves_nothing_on_failure(spark, tmp_path):
    target = str(tmp_path / "pack")

    def bad(tables):
        raise ValueError("check")

    with pytest.raises(ValueError):
        files.write_verified({"t": spark.range(3)}, target, bad)
    assert list(tmp_path.iterdir()) == []
    files.write_verified({"t": spark.range(3)}, target, lambda tables: tables["t"].count())
    assert spark.read.parquet(f"{target}/t").count() == 3
    with pytest.raises(FileExistsError):
        files.write_verified({"t": spark.range(3)}, target, lambda tables: None)


def test_json_sources(spark, tmp_path):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("s", T.StringType())])
    files.write_json_lines(spark.createDataFrame([(1, "é"), (2, None)], schema), str(tmp_path / "l"))
    assert sorted(tuple(r) for r in files.json_lines(spark, str(tmp_path / "l"), schema).collect()) == [(1, "é"), (2, None)]
    (tmp_path / "p").mkdir()
    (tmp_path / "p/page-1.json").write_text('{\n"n": 3}')
    assert files.json_pages(spark, str(tmp_path / "p/page-*.json"), schema).first().n == 3


def test_decoders_are_optional(spark):
    df = spark.createDataFrame([("x", b"")], "path string, content binary")
    if not decoders.can_decode():
        with pytest.raises(RuntimeError):
            decoders.native_pages(df)
    if not decoders.can_recognise():
        with pytest.raises(RuntimeError):
            decoders.recognised(df)


def test_intake_takes_each_content_once(spark, tmp_path):
    from lectern.streaming import intake

    depot = tmp_path / "depot"
    depot.mkdir()
    seen = []

    def handle(batch, number):
        seen.extend(bytes(r.content) for r in batch.collect())

    def go():
        intake.run_available(intake.first_copies(intake.new_files(spark, str(depot))), str(tmp_path / "checkpoint"), handle)

    (depot / "a.pdf").write_bytes(b"one")
    (depot / "b.pdf").write_bytes(b"one")
    go()
    (depot / "c.pdf").write_bytes(b"two")
    go()
    go()
    assert sorted(seen) == [b"one", b"two"]


def test_native_column_signal(spark):
    schema = "source string, page long, page_width int, text string, x0 int, y0 int, x1 int, y1 int"
    two = [("s", 1, 1000, "text line", x, y, x + 300, y + 10) for y in (0, 50, 100) for x in (50, 600)]
    got = layout.native_column_signal(spark.createDataFrame(two + [("s", 1, 1000, "a full line", 50, 200, 950, 210), ("s", 2, 1000, "abc", 0, 0, 1, 1)], schema))
    r = {x.page: x for x in got.collect()}
    assert (r[1].possible_multicolumn, r[1].full_width_lines, r[1].vertical_overlap_ratio) == (True, 1, 1.0) and r[2].status == "native_geometry_preserved"


def test_ink(spark):
    assert one(spark, integrity.ink_fraction(F.col("a")), [0, 255, 255, 249]) == 0.5


def test_shared_folder_without_a_setting():
    """A stand-in for a session whose spark.checkpoint.dir is unset, which no running session can be made to forget."""
    from types import SimpleNamespace

    from lectern.sources.shared import shared_dir

    conf = {"spark.sql.warehouse.dir": "hdfs://x/warehouse/"}
    assert shared_dir(SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d)))) == "hdfs://x/warehouse/lectern-shared"
    conf["spark.checkpoint.dir"] = "hdfs://x/own"
    assert shared_dir(SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d)))) == "hdfs://x/own"


def test_documents_and_reports_are_written_once(spark, tmp_path):
    import json

    from lectern.sources import files

    row = spark.createDataFrame([(1, "é", ["a", "b"])], "n int, said string, why array<string>")
    files.write_report(row, "Audit", str(tmp_path / "r"))
    read = lambda name: "\n".join(r.value for r in spark.read.text(str(tmp_path / "r" / name)).collect())
    assert read("report.md").startswith("# Audit\n") and "* why:\n  * a\n  * b" in read("report.md") and "é" in read("report.json")
    assert json.loads(read("report.json")) == {"n": 1, "said": "é", "why": ["a", "b"]}
    with pytest.raises(Exception):
        files.write_report(row, "Audit", str(tmp_path / "r"))
    with pytest.raises(ValueError):
        files.write_json_document(row.union(row), str(tmp_path / "x"))


def test_archives_that_cannot_be_unpacked_are_rows(spark):
    import io
    import zipfile

    from lectern.sources import files

    good, odd = io.BytesIO(), io.BytesIO()
    for target in (good, odd):
        with zipfile.ZipFile(target, "w") as z:
            z.writestr("a.txt", "hello")
    raw = bytearray(odd.getvalue())
    raw[raw.rindex(b"PK\x01\x02") + 8] |= 1  # marked as encrypted
    got = {(r.path, r.member, r.error) for r in files.zip_members(spark.createDataFrame([("good", good.getvalue()), ("odd", bytes(raw)), ("none", None), ("bad", b"x")], "path string, content binary")).collect()}
    assert got == {("good", "a.txt", None), ("odd", None, "RuntimeError"), ("none", None, "BadZipFile"), ("bad", None, "BadZipFile")}


def test_empty_store_and_upsert(spark):
    from lectern.operators import audit

    store = audit.empty_store(spark, {"metadata": "key string, value string"})
    changes = spark.createDataFrame([("a", "1", 1), ("a", "2", 2)], "key string, value string, seq int")
    assert [tuple(r) for r in audit.upserted(store["metadata"], changes).collect()] == [("a", "2")]


def test_long_fragment_chains_are_accepted(spark):
    """A chain of 70 fragments of two steps each, begun by one with a phase heading; one with another step breaks off."""
    from lectern.operators import fragments

    rows = [("m", p, "body", [2 * p, 2 * p + 1], int(p == 2), 2 * p, 2 * p + 1) for p in range(2, 72)] + [("m", 50, "left", [7, 8], 0, 7, 8)]
    frame = spark.createDataFrame(rows, "source string, page int, region string, step_numbers array<int>, n_phases int, first_step int, last_step int")
    context = spark.createDataFrame([("m", p, "c") for p in range(1, 73)], "source string, page int, chapter_id string")
    none = spark.createDataFrame([], "source string, page int, step_numbers array<int>")
    got = {(r.page, r.region): r.accepted for r in fragments.judged_fragments(frame, none, context).collect()}
    assert got == {(p, r): r == "body" for _, p, r, *_ in rows}
