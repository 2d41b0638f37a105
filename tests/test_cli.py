import json

from pyspark.sql import functions as F

from oreloom import cli, sinks
from oreloom.operators import reporting
from oreloom.streaming import ingest

TEXT = "Артикулы проекта\nЖК Северный\n\nКухня фасады Дуб каселла+Капучино Mebel.in 210 000₽\n\nЦвет стен RAL 7047\n\nДиван Divan.ru Слипсон Вельвет Зеленый 64 990₽\n\nДуховка DEXP M3XX от ДНС"


def test_all_stages(spark, tmp_path, capsys):
    root = tmp_path / "tree"
    root.mkdir()
    messages = [{"id": i, "type": "message", "date": f"2024-01-0{i}T10:00:00", "text": TEXT if i < 3 else "ничего"} for i in range(1, 4)]
    (root / "result.json").write_text(json.dumps({"messages": messages}), encoding="utf-8")
    out = str(tmp_path / "out")
    run = lambda *a: cli.main(list(a), spark)
    assert run("audit", "--root", str(root), "--out", out) == 0
    assert run("ingest", "--root", str(root), "--out", f"{out}/db") == 0
    db = ["--db", f"{out}/db"]
    assert run("stats", *db) == 0 and "canonical_posts: 3" in capsys.readouterr().out
    assert run("sample", *db, "--out", out) == 0
    assert run("candidates", *db, "--out", f"{out}/candidates", "--include-low") == 0
    assert run("extract-facts", *db, "--out", f"{out}/facts") == 0
    facts = ["--facts", f"{out}/facts"]
    clean = spark.read.option("header", True).csv(f"{out}/facts/facts_csv").where("needs_review = 'false'")
    assert clean.count() > 0
    assert run("review", *db, *facts, "--out", f"{out}/review", "--sample-size", "5") == 0
    assert run("review", *db, *facts, "--out", f"{out}/review", "--sample-size", "5", "--resume") == 0
    assert spark.read.parquet(f"{out}/review/reviews").count() == 5
    assert run("report", *facts, "--reviews", f"{out}/review", "--out", f"{out}/report") == 0
    assert "Suppliers" in (tmp_path / "out/report/report.md").read_text()
    assert run("palettes", *db, *facts, "--channel", "home", "--out", f"{out}/palettes") == 0
    assert run("index-all", *db, *facts, "--channel", "home", "--out", f"{out}/index") == 0
    assert {r.color_code for r in spark.read.parquet(f"{out}/index/paints").collect()} == {"RAL 7047"}
    read = lambda name: (tmp_path / "out" / name).read_text(encoding="utf-8")
    for folder in ("all", "clean", "needs_review"):
        assert "sofas" in read(f"facts/categories/{folder}/sofas.md") and "## Facts" in read(f"facts/categories/{folder}/kitchens.md")
    assert "keep" in read("review/by_decision/keep.md") and "## Reviews" in read("review/by_category/sofas.md") and "{fact}" in read("review/prompt_templates/user.txt")
    assert "## Corrected fields" in read("review/reviews.md") and "## Categories" in read("review/reviews.md")
    assert all(h in read("report/report.md") for h in ("## Reliability", "## Wood and neutral", "## To review by hand")) and "## Suppliers" in read("report/report_short.md") and "## Not shown" in read("report/quality_notes.md")
    assert all(h in read("report/category_sections/sofas.md") for h in ("## Values", "## Vendors", "## Examples", "Слипсон")) and "## Counters" in read("report/report_summary.md")
    assert "## Tiers" in read("palettes/quality_notes.md") and "## Wood and neutral" in read("palettes/palettes_short.md") and "## Contact sheet" in read("palettes/palettes.md")
    assert spark.read.option("header", True).csv(f"{out}/palettes/link_todo_csv").first().candidate_url.startswith("https://t.me/home/")
    assert spark.read.json(f"{out}/palettes/projects_jsonl").count() == spark.read.parquet(f"{out}/palettes/projects").count()
    kitchens = {r.project_id: r for r in spark.read.parquet(f"{out}/index/kitchen_wall_colors").collect()}
    assert kitchens[1].paint_codes == ["RAL 7047"] and kitchens[1].paint_messages == [1]
    assert all("#" in read(f"index/{n}.md") for n in ("paints", "appliances", "makers", "kitchen_wall_colors", "index"))
    assert spark.read.option("header", True).csv(f"{out}/index/paints_csv").count() == 2
    assert run("stats", "--db", f"{out}/missing") == 2
    assert run("review", *db, *facts, "--out", out, "--provider", "http", "--base-url", "http://127.0.0.1:9/v1") == 3


def test_display_values(spark):
    rows = [("Дуб каселла", "kitchens", "x", True), ("арт", "kitchens", "x", False), ("в ванной", "sofas", "x", False), ("1234567", "sofas", "x", False), ("RAL 7047", "wall_colors", "x", True), ("x" * 100, "sofas", "x", False), ("x" * 60 + " + " + "y" * 60, "kitchens", "kitchen_facades", True), ("в прихожей шкаф", "hallway", "x", False), ("14 990 ₽/шт", "sofas", "x", False), (None, "sofas", "x", False)]
    df = spark.createDataFrame(rows, "v string, c string, t string, want boolean").select("want", reporting.display_value(F.col("v"), F.col("c"), F.col("t")).alias("got"))
    assert all(r.want == r.got for r in df.collect())


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"], "x|y")], "id long, names array<string>, t string")
    assert sinks.flat(df).first().names == "a; b" and "x\\|y" in sinks.markdown_table(df, 5)
    assert {r.token for r in sinks.token_postings(spark.createDataFrame([(1, "Да и да"), (2, None)], "id long, t string"), "id", "t").collect()} == {"да", "и"}


def test_reports_are_whole(spark, tmp_path):
    df = spark.range(60).select("id", F.concat(F.lit("v"), "id").alias("v"))
    sinks.write_report(spark, str(tmp_path / "r.md"), "R", {"Some rows": df, "Few": df.limit(2)}, 50)
    text = (tmp_path / "r.md").read_text()
    assert text.count("| v") == 50 + 2 + 2 and text.count("Only the first 50 rows; all are in `r_tables/some_rows`") == 1
    assert spark.read.parquet(str(tmp_path / "r_tables/some_rows")).count() == 60


def test_report_top_is_by_category(spark, tmp_path):
    values = ("Дуб", "Ясень", "Орех")
    rows = [(i, c, v, 0.0) for c in ("kitchens", "sofas", "hallway") for i, v in enumerate(values)]
    used = spark.createDataFrame(rows, "id long, e_category string, e_model string, x double")
    used = used.select("*", *(F.lit(None).cast("string").alias(c) for c in ("e_finish", "e_material", "e_color", "e_color_code", "e_article_id", "e_brand", "e_item_type", "e_vendor", "evidence_quote")))
    sections = reporting.value_sections(used, 2)
    shown = sections["Values"].collect()
    assert [(r.e_category, r.place) for r in shown] == [(c, p) for c in ("hallway", "kitchens", "sofas") for p in (1, 2)]


def test_photos(spark, tmp_path):
    (tmp_path / "a.jpg").write_bytes(b"1")
    df = spark.createDataFrame([(7, [str(tmp_path / "a.jpg"), str(tmp_path / "gone.jpg")]), (8, None)], "project_id long, photo_paths array<string>")
    assert sinks.copy_photos(df, str(tmp_path / "out")) == {"7": [f"{tmp_path}/out/7-1.jpg"]}
    assert (tmp_path / "out" / "7-1.jpg").read_bytes() == b"1" and not sinks.contact_sheet([], str(tmp_path / "s.jpg"))


def test_stream(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "state")
    spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "message_id long, ord long, text string").write.parquet(source)
    stream = lambda: spark.readStream.schema("message_id long, ord long, text string").parquet(source)
    ingest.merge_stream(stream(), target, str(tmp_path / "cp")).awaitTermination(60)
    spark.createDataFrame([(1, 2, "c"), (1, 0, "z")], "message_id long, ord long, text string").write.mode("append").parquet(source)
    ingest.merge_stream(stream(), target, str(tmp_path / "cp")).awaitTermination(60)
    assert {r.message_id: r.text for r in ingest.read_state(spark, target).collect()} == {1: "c", 2: "b"}
    assert sorted(p.name for p in (tmp_path / "state").iterdir() if p.name.startswith("change")) == ["change-0", "change-1"]
    spark.createDataFrame([(2, 1, "later"), (3, 0, "new")], "message_id long, ord long, text string").write.mode("append").parquet(source)
    ingest.COMPACT, before = 1, ingest.COMPACT
    try:
        ingest.merge_stream(stream(), target, str(tmp_path / "cp")).awaitTermination(60)
    finally:
        ingest.COMPACT = before
    assert (tmp_path / "state" / "state-2").exists() and {r.message_id: r.text for r in ingest.read_state(spark, target).collect()} == {1: "c", 2: "later", 3: "new"}
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    assert ingest.sessions(events).agg(F.sum("n")).first()[0] == events.count()


def test_vendors_of_reports(spark):
    from oreloom import rules
    from oreloom.functions import parse

    rows = [("stool group", "Stoolgroup"), ("Лемана", "Лемана Про"), ("вайлдберриз", "Wildberries"), ("Alpine Floor", "Alpine Floor"), ("Own shop", "Own shop")]
    df = spark.createDataFrame(rows, "v string, want string").select("want", parse.normalize_vendor(F.col("v"), rules.REPORT_VENDORS).alias("got"))
    assert all(r.want == r.got for r in df.collect())


def test_provider_helpers():
    import pytest

    from oreloom.operators import review

    own = review.Recorder()
    assert json.loads(own("s", "p"))["decision"] == "keep" and own.calls == [("s", "p")]
    with pytest.raises(OSError):
        review.probe("http://127.0.0.1:9/v1", 1.0)


def test_kitchens_and_paints(spark):
    from oreloom.operators import rankings

    paints = spark.createDataFrame([(5, 9, "RAL 1", "telegram:1", "high", "green"), (4, 1, "RAL 2", "telegram:1", "high", "other"), (6, 1, "RAL 1", "telegram:1", "high", "blue"), (7, 1, "RAL 9", "telegram:2", "low", "blue")], "message_id long, start int, color_code string, project_key string, link_confidence string, shade_family string").withColumn("product_line", F.lit(None).cast("string"))
    projects = spark.createDataFrame([(1, "2024"), (2, "2025"), (3, None)], "project_id long, date string")
    links = spark.createDataFrame([("telegram:1", 4, "same_message"), ("telegram:1", 5, "explicit_project_link"), (None, 6, "same_message")], "project_key string, message_id long, link_method string")
    rows = [(r.project_id, r.paint_codes, r.shades, r.paint_messages, r.best_link) for r in rankings.kitchen_paints(projects, paints, links).collect()]
    assert rows == [(1, ["RAL 2", "RAL 1"], ["green", "blue"], [4, 5, 6], "explicit_project_link"), (2, [], [], [], None), (3, [], [], [], None)]
