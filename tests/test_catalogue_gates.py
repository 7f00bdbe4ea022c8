"""Load rules on several built pages, selected-courses mode (one pipeline run)."""

from pyspark.sql import functions as F

from fixture_pages import course_page
from gleaner.plans.catalogue import catalogue_from_pages
from gleaner.sources.pages import course_url


def test_gates_and_first_wins(spark):
    pages = [
        (10, "1000", "1", course_page("1000", "1", name="C1", inst_name="I-first")),
        (11, "1000", "2", course_page("1000", "2", name="C2", inst_name="I-second")),
        (12, "1000", "1", course_page("1000", "1", name="C1b", duration="8 Anos", cnaef="999 Outra",
                                       exams_html="Uma das seguintes provas:<br>99 Z<br>")),
        (13, "2000", "3", course_page("2000", "3", mail=False)),
        (14, "3000", "4", course_page("3000", "4", ects=None)),
        (15, "4000", "5", course_page("4000", "5").replace('<div class="cab1">Engenharia X</div>',
                                                            '<div class="cab1"><b>X</b>Y</div>')),
    ]
    rows = [(seq, inst, course, html) for seq, inst, course, html in pages]
    df = spark.createDataFrame(rows, "seq long, inst string, course string, html string")
    # page 12 repeats page 10's pair, so its URL gets a marker to stay a distinct page
    pages_df = df.select(
        F.col("seq").alias("page_id"), "seq",
        F.concat(course_url("inst", "course"), F.when(F.col("seq") == 12, F.lit("&r=1")).otherwise(F.lit(""))).alias("url"),
        "html",
    )
    selection = df.select(F.col("inst").alias("institution_code"), F.col("course").alias("course_code")).unionByName(
        spark.createDataFrame([("1000", "1&r=1")], "institution_code string, course_code string"))
    out = catalogue_from_pages(pages_df, selection=selection)
    t = {k: v.collect() for k, v in out["tables"].items()}

    inst = {r.code: r.name for r in t["institutions"]}
    assert inst == {"1000": "I-first", "3000": "Instituto Y", "4000": "Instituto Y"}  # 2000: no mail -> nothing
    assert sorted((r.institution, r.course, r.ects) for r in t["course_institution"]) == [
        ("1000", "1", 180), ("1000", "2", 180), ("4000", "5", 180)]  # 3000: no ECTS -> institution only
    assert sorted((r.institution, r.course, r.unit, r.ammount) for r in t["durations"]) == [
        ("1000", "1", "Semestres", 6), ("1000", "2", "Semestres", 6), ("4000", "5", "Semestres", 6)]
    assert [r.name for r in t["duration_units"]] == ["Semestres"]  # page 12 lost: '8 Anos' never stored
    assert [tuple(r) for r in t["cnaef_areas"]] == [("523", "Electrónica e automação")]
    assert sorted(r.code for r in t["exams"]) == ["07"]
    assert {r.code: r.name for r in t["courses"]} == {"1": "C1", "2": "C2", "5": None}
    assert out["violations"].count() == 0
    assert out["view"].count() == 3


def test_job_selected_courses_from_csv(spark, scratch):
    """The batch job in selected-courses mode: raw windows-1252 bodies + a selection CSV."""
    import os

    from fixture_pages import fixture_rows
    from gleaner.plans.job import run
    from gleaner.sources.sinks import read_catalogue

    spark.createDataFrame(fixture_rows(), "seq long, url string, content_type string, body binary").write.parquet(
        f"{scratch}/pages")
    os.makedirs(f"{scratch}/sel")
    with open(f"{scratch}/sel/courses.csv", "w") as f:
        f.write("institution_code,course_code\n3021,9003\n0300,9252")
    run(spark, f"{scratch}/pages", f"{scratch}/out", source=f"{scratch}/sel")
    t = read_catalogue(spark, f"{scratch}/out")
    assert [tuple(r) for r in t["course_institution"].collect()] == [(180, "3021", "9003")]
    view = spark.read.parquet(f"{scratch}/out/expanded_course_institution").collect()
    assert [tuple(r) for r in view] == [(180, "3021", "Instituto Y", "9003", "Engenharia X", 6, "Semestres")]
