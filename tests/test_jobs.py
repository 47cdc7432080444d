"""The commands: what they write, and what they say they left out."""

from checks import adapters as A
from terrafold.__main__ import main
from terrafold.operators.assemble import latest_where
from terrafold.plans.extract import NOT_READ, RunConfig, feature_records, input_counts, run
from terrafold.sinks.writers import write_parts
from terrafold.sources import files
from terrafold.sources.parts import written_ids


def test_lines_command_reports_and_adds_what_is_new(spark, sf, tmp_path, capsys):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    A.lines_with_noise(spark, sf).select("value").write.text(source)
    command = ["--input", source, "--output", out, "--tags", ",".join(A.EVENT_TAGS)]
    main([*command, "--validate", "deep"])
    said = capsys.readouterr().out
    assert "malformed" in said and "no_geometry" in said and "parquet ok" in said
    written = spark.read.parquet(f"{out}/parquet").count()
    main(command)
    assert NOT_READ in capsys.readouterr().out
    main([*command, "--skip-mode", "incremental", "--formats", "parquet,geojson"])
    assert spark.read.parquet(f"{out}/parquet").count() == written
    assert written_ids(spark, f"{out}/geojson", ["osm_id"]).count() == written


def test_elements_command(spark, sf, tmp_path, capsys):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for name, table in (("nodes", A.area_nodes), ("ways", A.area_ways), ("relations", A.area_relations)):
        table(spark, sf).write.parquet(f"{source}/{name}")
    main(["--job", "elements", "--input", source, "--output", out, "--tags", "landuse"])
    assert "parquet ok" in capsys.readouterr().out
    found = spark.read.parquet(f"{out}/parquet")
    assert found.count() == A.area_relations(spark, sf).count()


def test_staged_command_leaves_other_values_behind(spark, sf, tmp_path, capsys):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_parts(feature_records(A.event_lines(spark, sf), A.EVENT_TAGS), source)
    main(["--job", "staged", "--input", source, "--output", out, "--tags", "power,landuse", "--subtags", "tower"])
    assert "parquet ok" in capsys.readouterr().out
    values = {tuple(r) for r in spark.read.parquet(f"{out}/parquet").select("category", "sub_cat").distinct().collect()}
    assert values == {("power", "tower")}


def test_a_format_that_failed_is_filled_up(spark, sf, tmp_path):
    source, out = str(tmp_path / "in"), tmp_path / "out"
    A.event_lines(spark, sf).select("value").write.text(source)
    config = RunConfig(tags=["power"], formats=["parquet", "geojson"], skip_mode="incremental")
    out.mkdir()
    (out / "geojson").write_text("in the way")
    assert [x[:2] for x in run(spark, source, str(out), config)][0] == ("parquet", "ok")
    (out / "geojson").write_text("")
    (out / "geojson").unlink()
    assert [x[:2] for x in run(spark, source, str(out), config)] == [("parquet", "ok"), ("geojson", "ok")]
    written = spark.read.parquet(f"{out}/parquet").count()
    assert written_ids(spark, f"{out}/geojson", ["osm_id"]).count() == written


def test_what_a_run_leaves_out(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = ['{"bad', '{"geometry":null,"properties":{"power":"tower"}}', "x" * 400, ""]
    (tmp_path / "in" / "a").write_text("\n".join(lines) + "\n")
    counts = input_counts(spark, str(tmp_path / "in"), RunConfig(max_line_bytes=200)).collect()
    assert {(r["reason"], r["lines"]) for r in counts} == {("malformed", 1), ("no_geometry", 1), ("oversize", 1)}


def test_inputs_left_out_are_listed(spark):
    sizes = spark.createDataFrame(
        [("power", None, 10), ("power", "1", 5), ("power", "2", 0), ("road", None, 0), ("place", None, 1)],
        "category string, part string, bytes long",
    )
    kept = {(r["category"], r["part"]) for r in files.select_inputs(sizes).collect()}
    left = {(r["category"], r["part"], r["reason"]) for r in files.left_out_inputs(sizes).collect()}
    assert kept == {("power", "1"), ("place", None)}
    assert left == {("power", None, "has_parts"), ("power", "2", "small"), ("road", None, "small")}


def test_an_old_version_does_not_come_back(spark):
    rows = spark.createDataFrame(
        [(1, 1, "a"), (1, 2, "b"), (2, 1, "b"), (2, 3, "a"), (3, None, "a")], "id long, version int, value string"
    )
    kept = latest_where(rows, rows["value"] == "a").collect()
    assert sorted((r["id"], r["version"]) for r in kept) == [(2, 3), (3, None)]
