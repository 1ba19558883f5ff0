import json
from types import SimpleNamespace

import pytest

from verdigris.operators.corpus import to_conversations
from verdigris.plans import evaluation
from verdigris.sources import runs
from verdigris.sources.storage import scratch_path, stored
from verdigris.verification.fixtures import generations, pairs


@pytest.fixture(scope="module")
def scored(spark, sf_dir):
    sample = evaluation.evaluation_sample(to_conversations(pairs(spark, sf_dir)), 200)
    return stored(evaluation.score_generations(sample, generations(spark, sf_dir)), "scored")


CONFIG = evaluation.RunConfig("r1", 200, "base-model", "adapter", settings=(("seed", "42"),))


def test_evaluation_scores_the_sample_for_every_model(scored):
    counts = {r.model_id: r["count"] for r in scored.groupBy("model_id").count().collect()}
    assert counts == {"base": 200, "tuned": 200}


def test_run_document(spark, scored, tmp_path):
    path = str(tmp_path / "runs")
    document = evaluation.run_document(scored, CONFIG, "base", "tuned", "2025-01-01T00:00:00")
    runs.append_run(document, path)
    read = runs.read_runs(spark, path).collect()[0]
    assert read.run_id == "r1"
    assert read.evaluation_config.base_model == "base-model" and read.config == {"seed": "42"}
    assert read.baseline.num_samples == read.fine_tuned.num_samples == 200
    assert len(read.baseline.error_examples) == 5 and len(read.fine_tuned.sample_predictions) == 10
    assert read.improvement.correct_gain == read.fine_tuned.num_correct - read.baseline.num_correct
    assert read.improvement.absolute_improvement == pytest.approx(
        read.fine_tuned.accuracy - read.baseline.accuracy
    )
    in_order = scored.filter("model_id = 'base' AND NOT strict_match").orderBy("sample_rank").limit(5)
    assert [e.question for e in read.baseline.error_examples] == [r.question for r in in_order.collect()]


def test_one_sided_document(scored):
    document = evaluation.run_document(scored, CONFIG, "base", None, "t").collect()[0]
    assert document.fine_tuned is None and document.improvement is None
    assert document.baseline.num_samples == 200


def test_history_of_old_and_new_documents(spark, tmp_path):
    old = {"baseline": {"accuracy": 0.004, "num_samples": 1000, "num_correct": 4, "num_incorrect": 996},
           "improvement": {"absolute_improvement": 0.012, "relative_improvement_pct": 300.0, "correct_gain": 12}}
    new = {"baseline": {**old["baseline"], "parsing_valid_count": 975, "parsing_valid_rate": 0.975}}
    (tmp_path / "a.json").write_text(json.dumps(old, indent=2))
    (tmp_path / "b.json").write_text(json.dumps(new, indent=2))
    read = runs.read_runs(spark, f"{tmp_path}/*.json", "document")
    rows = sorted(runs.summary_history(read, "baseline").collect(), key=lambda r: r.source_file)
    assert [(r.parsing_valid_count, r.logical_form_accuracy, r.num_correct) for r in rows] == [(0, 0.0, 4), (975, 0.0, 4)]
    gains = sorted(runs.improvement_history(read).collect(), key=lambda r: r.source_file)
    assert [r.correct_gain for r in gains] == [12, None]
    assert runs.summary_history(read, "fine_tuned").count() == 0


def write_lines(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines))


ONE = '{"baseline": {"accuracy": 0.5}}'
TWO = '{"baseline": {"accuracy": 0.25}}'


def test_every_document_of_a_file_and_folder_comes_back(spark, tmp_path):
    write_lines(tmp_path / "run_id=1", "a.json", ONE, TWO)
    write_lines(tmp_path / "run_id=1", "b.json", ONE)
    write_lines(tmp_path / "run_id=x", "a.json", TWO)
    read = runs.read_runs(spark, str(tmp_path)).select("run_id", "baseline.accuracy").collect()
    assert sorted(map(tuple, read)) == [("1", 0.25), ("1", 0.5), ("1", 0.5), ("x", 0.25)]


@pytest.mark.parametrize("lines", [(ONE, TWO), (ONE, "rest"), ("{broken",), (f"{ONE},{TWO}",)])
def test_a_file_with_more_than_its_document_fails(spark, tmp_path, lines):
    write_lines(tmp_path, "a.json", *lines)
    with pytest.raises(Exception, match="MALFORMED|more than one JSON value"):
        runs.read_runs(spark, str(tmp_path), "document").collect()


def test_a_malformed_line_of_the_history_fails(spark, tmp_path):
    write_lines(tmp_path / "run_id=1", "a.json", ONE, '{"baseline": {')
    with pytest.raises(Exception, match="MALFORMED"):
        runs.read_runs(spark, str(tmp_path)).collect()


def test_appending_a_run_again_replaces_it(spark, scored, tmp_path):
    path = str(tmp_path / "runs")
    for run_id in ("r1", "r2", "r1"):
        config = evaluation.RunConfig(run_id, 200, "base-model")
        runs.append_run(evaluation.run_document(scored, config, "base", None, "t"), path)
    read = runs.read_runs(spark, path)
    assert sorted(r.run_id for r in read.collect()) == ["r1", "r2"]
    assert {r.num_samples for r in read.select("evaluation_config.num_samples").collect()} == {200}


def session_stub(shared, warehouse):
    settings = {"spark.checkpoint.dir": shared, "spark.sql.warehouse.dir": warehouse}
    return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default=None: settings[name] or default))


def test_scratch_path_is_in_a_folder_that_executors_share():
    assert scratch_path(session_stub("/shared/", "/house"), "x").startswith("/shared/x-")
    assert scratch_path(session_stub(None, "file:/house"), "x").startswith("file:/house/_scratch/x-")
