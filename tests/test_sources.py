"""Mail, registry log and incremental listing."""

from pyspark.sql import functions as F

from meetloom.sources import mail, registry_log, screening


def test_mail(spark):
    body = "[ Agenda ](https://lnks.gd/l/x) [PDF](https://links.govdelivery.com/a/https:%2F%2Ffile.lacounty.gov%2Fx.pdf/1) [again](https://file.lacounty.gov/x.pdf) [p](https://bos.lacounty.gov/board-meeting-agendas/)"
    m = spark.createDataFrame([("1", "News <News@County.example>", [], "Agenda for the Board Meeting of May 5, 2026", body, None, []), ("2", None, None, None, None, None, None), ("3", "x", [], "5/21/2025 3:00 PM - Parks Committee - CANCELLED - Meeting Agenda", "", None, [])], mail.MESSAGE)
    links = mail.message_links(m)
    assert [(r["category"], r["text"]) for r in links.orderBy("id", "pos").collect()] == [("external_page", "Agenda"), ("direct_pdf", "PDF"), ("direct_pdf", "again"), ("board_agenda_page", "p")]
    assert sorted(r["text"] for r in mail.download_targets(links).collect()) == ["PDF", "p"]
    got = {r["id"]: (r["message_type"], r["meeting_date"], r["relevant"]) for r in mail.assess(m, ["@county.example"]).collect()}
    assert got == {"1": ("board_agenda", "2026-05-05", True), "2": ("unknown", None, None), "3": ("unknown", "2025-05-21", False)}
    assert m.where("id = '3'").select(mail.body_of_subject(F.col("subject")).alias("b"), mail.kind_of(F.col("subject"), mail.CITY_KINDS).alias("k")).first() == ("Parks Committee", "meeting_cancellation_notice")


def test_registry_log(spark):
    source = {"source_ref": "a", "status": "live", "collection_role": "r", "activation_stage": "s", "access_model": "m", "public_urls": ["u"]}
    log = {"source_status_values": ["live"], "sources": [source, {**source, "status": "odd", "schedule": {}, "public_urls": []}, 7, {"source_ref": "b"}], "bodies": [{"body_id": "x", "sources": [{"source_ref": "zz"}]}], "activation_queue": {}}
    found = registry_log.problems(log)
    assert {m for s, m in found if s == "warning"} == {"a has no public_urls", "a has a schedule without cadence", "b has no public_urls"}
    assert {"activation_queue must be a list", "sources[2] must be a mapping", "repeated source_ref: a", "a has an unknown status: odd", "x names an unknown source: zz"} <= {m for _, m in found}
    assert registry_log.listing(spark, {"sources": [source]}, status="live").count() == 1 and registry_log.listing(spark, {"sources": [source]}, status="off").count() == 0


def test_incremental_listing(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub/b.txt").write_text("two")
    first = screening.list_files(spark, str(tmp_path))
    state = spark.createDataFrame(first.collect(), first.schema)
    assert screening.changed_files(first, state).count() == 0
    (tmp_path / "a.txt").write_text("three")
    assert [r["path"].rsplit("/", 1)[1] for r in screening.changed_files(screening.list_files(spark, str(tmp_path)), state).collect()] == ["a.txt"]
