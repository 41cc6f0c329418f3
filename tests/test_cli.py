"""The command line end to end on invented files."""

import json

from meetloom import cli, schemas
from meetloom.sources import jobs, store

AGENDA = """DATE: May 20, 2026
Operations Cluster

1. ITEMS:

A. Award a road maintenance contract
B. Tenant outreach
"""


def runner(tmp_path, capsys):
    base = ["--store", str(tmp_path / "wh"), "--config-dir", str(tmp_path / "cfg")]
    return lambda *a: (cli.main([*base, *a]), capsys.readouterr().out)


def test_import_read_and_reimport(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text(AGENDA)
    (tmp_path / "in/cancelled.txt").write_text(AGENDA)
    run = runner(tmp_path, capsys)
    assert json.loads(run("import-items", str(tmp_path / "in"), "s1")[1]) == {"documents_imported": 1, "items_imported": 2, "topics_imported": 4}
    _, out = run("list-items", "--topic", "homelessness")
    assert [json.loads(x)["item_label"] for x in out.splitlines()] == ["B"]
    made = json.loads(run("generate-findings")[1])
    assert made["findings_written"] == 2
    # A change of one item takes its findings along; the other's stay.
    (tmp_path / "in/a.txt").write_text(AGENDA.replace("B. Tenant outreach", "C) Fire watch"))
    run("import-items", str(tmp_path / "in"), "s1")
    assert sorted(json.loads(x)["title"] for x in run("list-items")[1].splitlines()) == ["Award a road maintenance contract", "Fire watch"]
    assert [json.loads(x)["title"] for x in run("list-findings")[1].splitlines()] == ["Award a road maintenance contract"]
    tables = store.Store(spark, str(tmp_path / "wh"))
    assert tables.read("finding_topics", schemas.FINDING_TOPICS).join(tables.read("findings", schemas.FINDINGS), "finding_id", "left_anti").count() == 0
    assert tables.read("meetings", schemas.MEETINGS).count() == tables.read("documents", schemas.DOCUMENTS).count() == 1
    run("generate-findings")
    assert {json.loads(x)["action_classification"] for x in run("list-findings", "--limit", "5")[1].splitlines()} == {"contract_award", "informational_item"}
    shown = json.loads(run("dashboard-summary")[1])
    assert (shown["structured_items"], shown["findings"], shown["sources"][0]["latest_structured_date"], len(shown["top_findings"]), len(shown["recent_agendas"])) == (2, 2, "2026-05-20", 2, 1)
    assert "High-Signal Items" in run("weekly-digest")[1] and json.loads(run("backfill-structured-dates")[1]) == {"items": 0, "documents": 0, "meetings": 0}
    assert "la_county_cluster_text" in run("list-parsers")[1]
    assert json.loads(run("screen-files", str(tmp_path / "in"))[1]) == {"reason": "cancellation_notice", "paths": 1}
    assert json.loads(run("parliamentary-summary")[1].splitlines()[0])["with_vote"] == 0


def test_refresh_reads_what_changed(spark, tmp_path, capsys):
    root = tmp_path / "in"
    (root / "x/supporting_docs").mkdir(parents=True)
    (root / "a.txt").write_text(AGENDA)
    (root / "canceled.txt").write_text(AGENDA)
    (root / "x/supporting_docs/supporting_001_7.txt").write_text("Board letter\nabout a contract\n")
    (tmp_path / "cfg").mkdir()
    (tmp_path / "cfg/s.yaml").write_text(f"source_id: s1\nsource_name: One\nstatus: active\ndownload_root: {root}\nparser: la_county_cluster_text\n")
    run = runner(tmp_path, capsys)
    first = json.loads(run("refresh-source", "s1")[1])
    assert (first["text_files_discovered"], first["new_or_changed_text_files"], first["items_written"], first["screened_out_breakdown"]) == (1, 1, 2, {"cancellation_notice": 1, "supporting_material": 1})
    assert first["findings_summary"]["findings_written"] == 2
    again = json.loads(run("refresh-source", "s1")[1])
    assert (again["new_or_changed_text_files"], again["import_summary"]) == (0, None)
    tables = store.Store(spark, str(tmp_path / "wh"))
    path = next(p for p in (r["path"] for r in jobs.screening.list_files(spark, str(root)).collect()) if "supporting" in p)
    raw = spark.createDataFrame([("doc_raw", "s1", "e", "t", path), ("doc_new", "s1", "e", "t", " ")], "document_id string, source_id string, external_id string, title string, text_path string")
    jobs.upsert_raw_documents(tables, raw)
    second = json.loads(run("refresh-supporting-docs", "s1", "--skip-findings")[1])
    assert (second["documents_written"], second["findings_summary"]) == (1, None)
    found = tables.read("items", schemas.ITEMS).where("document_role = 'board_letter'").first()
    assert found["source_document_id"] == "doc_raw"
    (root / "a.txt").write_text(AGENDA + "C. Fire watch\n")
    assert json.loads(run("refresh-source", "s1")[1])["new_or_changed_text_files"] == 1
    shown = json.loads(run("dashboard-summary", "--registered")[1])
    assert (shown["source_count"], shown["active_source_count"], shown["raw_documents"], shown["sources"][0]["source_name"]) == (1, 1, 2, "One") and shown["sources"][0]["latest_refresh_recorded_at"]
    run("persist-items", str(root), str(tmp_path / "json"))
    docs = spark.read.json(str(tmp_path / "json"))
    assert {r["item_count"] for r in docs.collect()} == {1, 3 if docs.where("item_count = 3").count() else 2}


def test_index_import_and_registry_commands(spark, tmp_path, capsys):
    run = runner(tmp_path, capsys)
    rows = [{"source_path": "/d/a.txt", "section_number": "1", "item_label": "A", "title": "One", "text_block": "One", "meeting_date": "May 20, 2026", "document_role": "", "topic_tags": ["budget"]}, {"source_path": "/d/a.txt", "item_label": "A", "title": "One", "text_block": "later"}]
    (tmp_path / "index.json").write_text(json.dumps(rows))
    assert json.loads(run("import-structured-items", str(tmp_path / "index.json"), "s2")[1]) == {"documents_imported": 1, "items_imported": 2, "topics_imported": 1}
    (kept,) = [json.loads(x) for x in run("list-items", "--source-id", "s2")[1].splitlines()]
    assert (kept["text_block"], kept["document_role"], kept["topic_tags"]) == ("later", "agenda", ["budget"])
    (tmp_path / "cfg").mkdir()
    (tmp_path / "cfg/b.yaml").write_text("source_id: b\nbase_url: old\nstatus: active\n")
    log = {"sources": [{"source_ref": "r", "status": "live", "collection_role": "x", "activation_stage": "y", "access_model": "z", "current_source_id": "b", "public_urls": ["https://new"], "schedule": {"cadence": "weekly"}, "freshness": {"last_failure": None}}], "bodies": []}
    (tmp_path / "log.yaml").write_text(json.dumps(log))
    assert run("validate-source-log", str(tmp_path / "log.yaml"))[0] == 0
    assert json.loads(run("list-source-log", str(tmp_path / "log.yaml"))[1])["cadence"] == "weekly"
    assert json.loads(run("sync-source-config", str(tmp_path / "log.yaml"), "r")[1])["written"] is False
    assert json.loads(run("activate-source", str(tmp_path / "log.yaml"), "r", "--write")[1])["sync"]["changes"] == {"base_url": "https://new"}
    assert "base_url: https://new" in (tmp_path / "cfg/b.yaml").read_text()
    assert json.loads(run("list-sources")[1])[0]["source_id"] == "b"
    assert "meetloom" in run("about")[1]
