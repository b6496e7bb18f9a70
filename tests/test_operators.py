"""Operators on small literal rows, with the edge cases at each threshold."""

import datetime
import io
import zipfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from epistola.functions import phones, plugins
from epistola.functions import text as tx
from epistola.operators import contacts as ct
from epistola.operators import filters as fl
from epistola.operators import joins, mail, rollups, scoring, state
from epistola.operators.components import components
from epistola.sources import config, files, mailbox, office, sinks

DEDUP = [
    (0, "A One", "a.one@example.com", "+7 (495) 123-45-67", 'Org "X"', "Manager", 0.9),
    (1, "A One", "a.one@example.com", "+7-495-123-45-67", "Org X", "Senior manager", 0.8),
    (2, "B Two", "b.two@example.com", "+7 (916) 555-66-77", "OrgY", "Director", 0.7),
    (3, "C Three", "", "8-916-555-66-77", "Other org", "Clerk", 0.6),
    (4, "D Four", "d.four@example.org", "+7 (903) 777-88-99", "OrgZ", "Specialist", 0.85),
]


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())] if values else [(1,)], list(values) or ["x"])
    return row.select(column.alias("out")).first()["out"]


def each(spark, f, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["out"] for r in rows.orderBy("i").select(f(F.col("v")).alias("out")).collect()]


@pytest.fixture(scope="module")
def dedup(spark):
    return spark.createDataFrame(DEDUP, "ord long, name string, email string, phone string, organization string, position string, confidence double").withColumn("city", F.lit(""))


def test_phones(spark):
    assert each(spark, tx.normalize_phone, ["8 (916) 555-66-77", "79165556677", None, "+7 916 555 66 77"]) == ["+79165556677", "79165556677", "", "+79165556677"]
    assert each(spark, tx.normalize_phone_strict, ["8-916-555-66-77", "9165556677", "12"]) == ["79165556677", "79165556677", "12"]
    assert each(spark, tx.phone_key, ["+7 (916)", "+7 (9165)", None]) == [None, None, None]
    got = each(spark, phones.extract_phones, ["8(495)123-45-67 доб. 12", "ext 5 8 916 555 66 77", "+7 (495) 123-45-67 (9), вн. 3", "+7 (495) 123-45-67" + " " * 60 + "доб. 1", "x" * 20_000 + " 8 495 123 45 67"])
    assert got == [["+7 (495) 123-45-67 (доб. 12)"], ["+7 (916) 555-66-77"], ["+7 (495) 123-45-67 (доб. 3)", "+7 (495) 123-45-09 (доб. 3)"], ["+7 (495) 123-45-67"], ["+7 (495) 123-45-67"]]
    assert each(spark, lambda c: phones.extract_phones(c, 15_000), ["x" * 20_000 + " 8 495 123 45 67"]) == [[]]
    assert each(spark, phones.comma_pairs, ["+7(3822) 12-34-56, 65-43-21 and +7 (495) 123-45-67,1234567"]) == [["+7 (3822) 12-34-56", "+7 (3822) 65-43-21", "+7 (495) 123-45-67", "+7 (495) 123-45-67"]]
    assert each(spark, phones.extract_phones, ["call 8(495)123-45-67 or +7 916 555 66 77", "+7(38822) 6-43-63, 6-43-65", None]) == [["+7 (495) 123-45-67", "+7 (916) 555-66-77"], ["+7 (388) 226-43-63", "+7 (388) 226-43-65"], []]
    assert each(spark, phones.extensions, ["доб. 123 ext 9 Доб 123", ""]) == [["доб. 123", "доб. 9"], []]
    assert each(spark, phones.is_mobile, ["+7 (916) 1", "+7 (911) 1", "+7 (935) 1", "+7 (999) 1"]) == [True, False, False, True]
    assert each(spark, phones.expand_scientific, ["n 7.9E+10 x"]) == ["n 79000000000 x"]
    assert len(phones.MOBILE) == len(set(phones.MOBILE)) == 59
    assert one(spark, phones.variant(F.lit("+7 (495) 123-45-67"), F.lit("9"))) == "+7 (495) 123-45-09"


def test_headers(spark):
    assert each(spark, tx.address_of, ["A <a@b.ru>", "see a@b.ru now", " x ", None]) == ["a@b.ru", "a@b.ru", "x", ""]
    assert each(spark, lambda c: tx.domain(c), ["A <a@B.ru>", "none", None]) == ["b.ru", None, None]
    dates = each(spark, lambda c: tx.date_folder(tx.parse_mail_date(c)), ["Tue, 29 Jul 2025 20:30:00 +0300", "29 Jul 2025 18:30:00", "29 Jul 2025 10:00:00 GMT", "no date", None])
    assert dates == ["2025-07-30", "2025-07-30", "2025-07-29", None, None]
    assert one(spark, plugins.decoded(F.lit("=?utf-8?B?0J/RgNC40LLQtdGC?="))) == "Привет"
    a, b = (one(spark, tx.thread_id(F.lit("x@a.b.ru"), F.lit(s), F.lit("Tue, 29 Jul"), F.lit("2025-07-29").cast("date"))) for s in ("Re: Offer", "Offer"))
    assert a == b and a.startswith("20250729_a_b_ru_")
    assert one(spark, tx.thread_id(F.lit("nobody"), F.lit("Fwd: Re: x"), F.lit(None).cast("string"), F.lit("2025-07-29").cast("date"))).startswith("20250729_unknown_")
    assert each(spark, tx.safe_filename, ["отчёт №1?.pdf"]) == ["отчёт _1_.pdf"]


def test_subject_and_sender_rules(spark):
    assert each(spark, lambda c: fl.subject_rule(c, ["Sale", "news"]), ["Big SALE", "News sale", "", None]) == ["sale", "news", None, None]
    rules = ["info@*", "*@bad.example", "x@y.example", "sale*@*"]
    assert each(spark, lambda c: fl.blacklist_rule(c, rules), ["INFO@any.ru", "a@bad.example", " x@y.example ", "xx@y.example", "sales@z.ru", "sale*@z.ru"]) == ["info@*", "*@bad.example", "x@y.example", None, None, "sale*@*"]


def test_mass_mailing_counts_repeats(spark):
    for n, want in ((9, False), (10, True), (11, True)):
        to = F.array(*[F.lit("a@own.ru")] * n)
        assert one(spark, fl.is_mass_mailing(F.lit("b@OWN.ru"), to, F.lit(None).cast("array<string>"), "own.ru")) is want


def test_attachment_rules(spark):
    status = lambda name, size=10**6, inline=False, shape=None, known=False, rules=("draft*",): one(spark, fl.attachment_status(F.lit(name), F.lit(size), F.lit(inline), F.lit(shape).cast("string"), F.lit(known), list(rules)))
    assert status("image001.png") == "excluded_by_name" and status("~image001.png") == "excluded_by_base_name"
    assert status("_.jpg") == "excluded_by_name" and status("blocked.gif") == "excluded_by_name"
    assert status("~Draft 1.pdf") == "excluded_by_filter" and status("__") == "excluded_by_filter"
    assert status("__", rules=()) == "unsupported"
    assert status("image7.png", 49_999) == "excluded_by_size" and status("image7.png", 50_000) == "saved"
    assert status("a.png", 10_000_000) == "saved" and status("a.png", 10_000_001) == "excluded_by_size"
    assert status("a.png", 83_509) == "excluded_by_size" and status("a.pdf", 83_509) == "saved"
    assert status("a.png", 10**5, shape="416x250") == "excluded_by_size"
    assert status("x.gif") == "excluded" and status("x.zip") == "excluded" and status("x.dat") == "unsupported"
    assert status("contract.docx") == "saved" and status("contract.docx", known=True) == "already_exists"
    assert [one(spark, fl.part_role(F.lit(d), F.lit(k), F.lit(n))) for d, k, n in (("attachment; x", "application/pdf", "a"), ("inline", "image/png", "a.png"), (None, "image/png", "a.png"), (None, "text/plain", None))] == ["attachment", "inline", "attachment", "body"]
    assert fl.glob_to_regex("a[!b]?.*") == r"(?s)^a[^b].\..*$"


def test_size_gates(spark):
    assert each(spark, fl.too_large, [-1, 100_000_000, 100_000_001], "long") == [False, False, True]
    gate = lambda size, s: one(spark, fl.needs_text_only(F.lit(size), F.lit(s)))
    assert gate(-1, "ATTACHMENT 20000001") and not gate(-1, "attachment 20000000") and not gate(49_999_999, "application/zip")
    assert gate(50_000_000, "application/zip") and not gate(-1, "video/ 30000000") and not gate(-1, 'attachment boundary="30000000"')
    assert not gate(-1, "attachment 200000001") and not gate(-1, "attachment " + "9" * 60)


def test_tiered_dedup_and_merge(spark, dedup):
    got = {r["ord"]: r for r in ct.tiered(dedup).collect()}
    assert sorted(got) == [0, 2, 3, 4]
    first = got[0]
    assert (first["position"], first["confidence"], first["organization"], first["phone"], first["other_phones"], first["n"]) == ("Senior manager", 0.9, 'Org "X"', "+7 (495) 123-45-67", "+7-495-123-45-67", 2)


def test_transitive_dedup_of_the_same_rows(spark, dedup):
    assert {r["ord"]: r["root"] for r in ct.transitive(dedup).collect()} == {0: 0, 1: 0, 2: 2, 3: 2, 4: 4}


def test_transitive_merge_of_the_same_rows(spark, dedup):
    got = {r["key"]: r for r in ct.transitive_merged(dedup).collect()}
    assert sorted(got) == [0, 2, 4] and got[2]["n"] == 2 and got[2]["phone"] == "+7 (916) 555-66-77" and got[2]["other_phones"] == "8-916-555-66-77" and got[2]["name"] == "C Three"
    bridge = spark.createDataFrame([(0, "A", "a@x.ru", ""), (1, "B", "", "89161112233"), (2, "Long name", "a@x.ru", "89161112233")], "ord long, name string, email string, phone string")
    row = ct.transitive_merged(bridge.withColumns({c: F.lit("") for c in ("organization", "position", "city")} | {"confidence": F.lit(0.5)})).first()
    assert (row["key"], row["n"], row["name"], row["email"], row["phone"]) == (0, 3, "Long name", "a@x.ru", "89161112233")


def test_greedy_dedup_forgets_dropped_rows(spark):
    rows = spark.createDataFrame([(1, 1, "a@x.ru", "1234567"), (1, 2, "b@x.ru", "1234567"), (1, 3, "b@x.ru", "7654321"), (2, 4, None, None), (2, 5, None, None)], "d int, ord long, email string, phone string")
    assert sorted(r["ord"] for r in ct.greedy(rows, "d").collect()) == [1, 3, 4, 5]


def test_contact_validation(spark):
    rows = spark.createDataFrame([(" ", "", None, "1"), ("A", " a@b.ru ", "123", "x"), (None, "bad", "+7 (495) 123-45-67", "1.5")], "name string, email string, phone string, confidence string")
    rows = rows.withColumns({c: F.lit(None).cast("string") for c in ("organization", "position", "city")})
    got = sorted((r["name"], r["email"], r["phone"], r["confidence"], r["city"]) for r in ct.validate(rows).collect())
    assert got == [("", "", "+7 (495) 123-45-67", 1.0, ""), ("A", "a@b.ru", "", 0.0, "")]


def test_answers(spark):
    get = lambda s: one(spark, ct.parse_answer(F.lit(s)))
    a = get('<think>{x}</think>Here: {"contacts":[{"name":null,"email":"a@b.ru","confidence":"0.9"}],"business_context":{"urgency":"high"},"action_items":"call"}')
    assert a["ok"] and a["contacts"][0]["email"] == "a@b.ru" and a["context_is_object"] and a["actions"] == "call"
    b = get('{"contacts":[],"business_context":"ok","recommended_actions":"ok"}')
    assert b["ok"] and not b["context_is_object"] and b["context"] == "ok"
    assert not get("no json")["ok"]


def test_priority_boundaries(spark):
    def score(city="", position="", org="", urgency=None, product=None, email="", phone="", conf=0.8):
        c = [F.lit(x).cast("string") for x in (city, position, org, urgency, product, email, phone)]
        return one(spark, scoring.contact_priority(*c, F.lit(conf)))

    full = score(city="Japan", email="a", phone="1", conf=0.95)
    assert full["score"] == 0.5 + 0.15 + 0.05 + 0.05 + 0.05 and full["level"] == "high"
    assert score(phone="1")["score"] == 0.5 and score(email="a")["reasons"] == []
    assert score(conf=0.7)["score"] == 0.5 and score(conf=0.69)["score"] == 0.4 and score(conf=0.9)["score"] == 0.5
    assert score("Japan", "Director", "Clinic", "HIGH", "Analyzer", "a", "1", 0.95)["score"] == 1.0
    assert one(spark, scoring.region_priority(F.lit("")))["level"] == "unknown"
    assert one(spark, scoring.regional_contact_priority(F.lit(""), F.lit(None).cast("string"), F.lit(None).cast("boolean"), F.lit(None).cast("string")))["factors"] == ["region_unknown"]
    top = one(spark, scoring.regional_contact_priority(F.lit("France"), F.lit("KIT"), F.lit(True), F.lit("urgent")))
    assert top["level"] == "critical" and abs(top["score"] - 0.96) < 1e-12


def test_text_quality(spark):
    q = lambda t, m: one(spark, scoring.text_quality(F.lit(t).cast("string"), F.lit(m)))
    assert q(None, "x")["level"] == "failed" and q("", "x")["score"] == 0.0
    assert q("write to a@b.ru " + "x" * 60, "direct")["score"] == 1.2
    assert q("[ERROR", "ocr")["score"] == -0.2


@pytest.mark.parametrize("n,want", [(0, 1), (10_000, 1), (10_001, 1), (12_000, 1), (12_001, 2), (19_000, 2), (19_001, 3)])
def test_chunks_cover_the_text(spark, n, want):
    body = "".join(chr(97 + i % 26) for i in range(n))
    rows = mail.chunks(spark.createDataFrame([(1, body)], "id int, body string"), "id", "body").orderBy("n").collect()
    assert len(rows) == want == rows[0]["total"]
    assert rows[0]["start"] == 0 and rows[-1]["stop"] == n
    for r in rows:
        assert (r["text"].split("]\n", 1)[1] if want > 1 else r["text"]) == body[r["start"] : r["stop"]]
    assert all(b["start"] == a["stop"] - 1000 for a, b in zip(rows, rows[1:], strict=False))


def test_delay():
    d = state.Delay(2, 1, 5)
    d.step("success")
    assert d.delay == 1.6
    d = state.Delay(1, 0.5, 3)
    d.step("rate_limit_error")
    assert d.delay == 1.5
    for _ in range(3):
        d.step("success")
    assert abs(d.delay - 0.768) < 1e-12
    d = state.Delay()
    used = [d.step("success") for _ in range(6)]
    assert [round(x, 3) for x in used] == [30, 24, 19.2, 15.36, 12.288, 30]
    assert state.wait(30, None) == 0 and state.wait(30, 10) == 20
    assert state.next_provider([("a", True), ("b", False), ("c", True)], "a") == "c" and state.next_provider([("a", True)], "a") is None
    assert state.backoff(20) <= 450
    d = state.Delay(30, 10, 120)
    assert d.step("unknown") == 30 and d.state() == (30, 0, 0)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["success", "rate_limit_error", "timeout", "other_error"])))
def test_delay_stays_in_bounds(outcomes):
    d = state.Delay()
    for o in outcomes:
        d.step(o)
        assert state.LOWEST <= d.delay <= state.HIGHEST


def test_breaker():
    b = state.Breaker()
    assert [b.step(t, ok) for t, ok in ((0, False), (1, False), (2, False), (100, True), (302, True), (303, False))] == ["closed", "closed", "tripped", "open", "closed", "closed"]


def test_retry_queue(spark):
    rows = [(1, i, float(i), ok) for i, ok in enumerate((False, False, True, False))] + [(2, i, float(i), False) for i in range(4)] + [(3, 0, 0.0, True)]
    got = {r["message"]: (r["attempts"], r["dead"]) for r in state.retry_queue(spark.createDataFrame(rows, "message int, event_id int, ts double, ok boolean")).collect()}
    assert got == {1: (1, False), 2: (3, True), 3: (0, False)}


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(5, 5)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 30)}


def test_joins(spark):
    spine = joins.date_spine(spark, "2024-02-28", "2024-03-01")
    assert [r["day"] for r in spine.collect()] == [datetime.date(2024, 2, 28), datetime.date(2024, 2, 29), datetime.date(2024, 3, 1)]
    with pytest.raises(ValueError):
        joins.date_spine(spark, "2024-03-02", "2024-03-01")
    rows = spark.createDataFrame([(1, 3), (1, 1), (2, 2)], "k int, v int")
    assert joins.limited(rows, "k", None, "v").count() == 3 and joins.limited(rows, "k", 1, "v").count() == 2


def test_health(spark):
    rows = spark.createDataFrame([("a", True, True, 4), ("b", False, True, 0), ("c", True, False, 0)], "provider string, active boolean, has_key boolean, failures int")
    got = {r["provider"]: (r["status"], r["system"]) for r in rollups.provider_health(rows).collect()}
    assert got == {"a": ("unhealthy", "warning"), "b": ("disabled", "warning"), "c": ("no_api_key", "warning")}


def test_mail_records_and_combined_text(spark):
    a = "array<struct<status:string,is_inline:boolean>>"
    raw = spark.createDataFrame([("A <a@x.ru>", "b@y.ru, c@y.ru, d@y.ru, E@y.ru", None, "Re: hi", "Tue, 29 Jul 2025 20:30:00 +0300", "", "body", [("saved", False), ("excluded", True)], 10)], f"`from` string, `to` string, cc string, subject string, `date` string, message_id string, body string, attachments {a}, raw_size long")
    r = mail.records(raw).first()
    assert r["from"] == "a@x.ru" and r["to"] == "b@y.ru, c@y.ru, d@y.ru..." and r["to_emails"][3] == "e@y.ru" and r["date_folder"] == "2025-07-30"
    assert r["attachments_stats"]["saved"] == 1 and r["attachments_stats"]["inline_images"] == 1 and r["message_id"].startswith("generated_")
    assert one(spark, mail.cache_date(F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit("29.07.2025 10:00"))) == "2025-07-29"


def test_office_files(spark):
    def pack(files):
        b = io.BytesIO()
        with zipfile.ZipFile(b, "w") as z:
            for name, text in files.items():
                z.writestr(name, text)
        return b.getvalue()

    w, s = office._W.strip("{}"), office._S.strip("{}")
    docx = pack({"word/document.xml": f'<w:document xmlns:w="{w}"><w:p><w:t>one</w:t></w:p><w:p><w:t>two</w:t></w:p></w:document>'})
    xlsx = pack({"xl/sharedStrings.xml": f'<sst xmlns="{s}"><si><t>hi</t></si></sst>', "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{s}"><row><c t="s"><v>0</v></c><c><v>0</v></c><c><v>5</v></c></row></worksheet>'})
    rows = spark.createDataFrame([("/a.docx", docx), ("/b.XLSX", xlsx), ("/c.docx", b"bad"), ("/d.pdf", b"x")], "path string, content binary")
    got = {r["path"]: (r["text"], r["success"]) for r in office.extract(rows).collect()}
    assert got == {"/a.docx": ("one\ntwo", True), "/b.XLSX": ("hi |  | 5", True), "/c.docx": ("", False), "/d.pdf": ("", False)}


def test_mailbox_source(spark, tmp_path):
    day = tmp_path / "2025-07-29"
    day.mkdir()
    (day / "1.eml").write_bytes(b"From: A <a@x.ru>\r\nTo: b@y.ru\r\nSubject: =?utf-8?B?0J/RgNC40LLQtdGC?=\r\nDate: Tue, 29 Jul 2025 20:30:00 +0300\r\nContent-Type: text/plain\r\n\r\nhello from the mailbox\r\n")
    spark.dataSource.register(mailbox.MailboxSource)
    rows = spark.read.format("mailbox").option("path", str(tmp_path)).option("first", "2025-07-28").option("last", "2025-07-30").load().collect()
    assert len(rows) == 1 and rows[0]["subject"] == "Привет" and rows[0]["body"].strip() == "hello from the mailbox"
    heads = spark.read.format("mailbox").option("path", str(tmp_path)).option("first", "2025-07-29").option("last", "2025-07-29").option("headers", "true").load().first()
    assert heads["subject"] == "Привет" and heads["body"] is None and heads["raw_size"] == rows[0]["raw_size"]
    assert mailbox.read_message(b"Content-Type: text/html\r\n\r\n<b>hello &amp; welcome</b> to all", "d")[7] == "hello   welcome to all"
    asked = []

    def shaky(path, day):
        asked.append(day)
        for i in range(4):
            if i == 2 and len(asked) < 3:
                raise OSError
            yield b"%d" % i

    reader = mailbox.MailboxReader({"path": "", "first": "2025-07-29", "last": "2025-07-29"}, shaky)
    assert list(reader._fetched("x")) == [b"0", b"1", b"2", b"3"] and len(asked) == 3
    with pytest.raises(OSError):
        list(mailbox.MailboxReader({"path": "", "first": "2025-07-29", "last": "2025-07-29", "attempts": "1"}, lambda p, d: open("/nowhere"))._fetched("x"))


def test_files_and_sinks(spark, tmp_path):
    rules = tmp_path / "rules.txt"
    rules.write_text("# comment\n\nSale\n****\n news \n")
    assert files.rules(spark, str(rules)) == ["news", "sale"]
    (tmp_path / "t").mkdir()
    (tmp_path / "t/a___ocr.txt").write_text("head\n# ====\n\nthe text")
    got = files.cached_texts(spark, str(tmp_path / "t")).first()
    assert (got["stem"], got["method"], got["text"]) == ("a", "ocr_cached", "the text")
    for d in ("2025-01-01", "2025-01-02"):
        (tmp_path / f"m/date_folder={d}").mkdir(parents=True)
        (tmp_path / f"m/date_folder={d}/email_001.json").write_text('{"thread_id": "%s", "body": "b"}' % d)
    (tmp_path / "m/date_folder=2025-01-02/email_002.json").write_text("{broken")
    assert [r["thread_id"] for r in files.mails(spark, str(tmp_path / "m"), "2025-01-02").collect()] == ["2025-01-02"]
    assert files.days(spark, str(tmp_path / "m")).count() == 2
    rows = spark.createDataFrame([(1, "x")], "a int, b string")
    sinks.write_csv(rows, str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).first()["b"] == "x"
    sinks.write_envelope(rows, str(tmp_path / "env"), "now")
    assert spark.read.json(str(tmp_path / "env")).first()["data"]["a"] == 1
    assert "<td>x</td>" in sinks.html_report(rows, "t")
    with pytest.raises(ValueError):
        sinks.html_report(spark.range(5), "t", 4)
    twice = spark.createDataFrame([("2025-01-01", "m")], "date_folder string, body string")
    for _ in range(2):
        sinks.write_mails(twice, str(tmp_path / "mails"))
    assert spark.read.json(str(tmp_path / "mails")).count() == 1
    texts = spark.createDataFrame([("2025-01-01", "a", "docx", 1.0, True, "t"), ("2025-01-01", "b", "ocr", 0.0, False, "")], "day string, file_name string, method string, confidence double, success boolean, text string")
    report = sinks.write_extracted(texts, str(tmp_path / "texts")).first()
    assert (report["files"], report["successful"], report["pct"], report["confidence"]) == (2, 1, 50.0, 1.0) and spark.read.json(str(tmp_path / "texts")).count() == 1
    assert sinks.first_that_works(rows, lambda r: 1 / 0, lambda r: r.count()) == 1
    stored = spark.createDataFrame([("2025-01-01", "a.pdf")], "date_folder string, original_filename string")
    new = spark.createDataFrame([("2025-01-01", "a.pdf", b"1"), ("2025-01-01", "b.pdf", b"2")], "date_folder string, original_filename string, content binary")
    assert [r["original_filename"] for r in sinks.write_new_attachments(new, stored, str(tmp_path / "att")).collect()] == ["b.pdf"]


def test_plugins(spark):
    rows = spark.createDataFrame([(1, "write to a@b.ru or c@d.ru, +7 495 123-45-67"), (2, None)], "i int, t string")
    got = {r["i"]: r["a"] for r in plugins.answer(rows, "i", "t").select("i", ct.parse_answer(F.col("answer")).alias("a")).collect()}
    assert [c["email"] for c in got[1]["contacts"]] == ["a@b.ru", "c@d.ru"] and got[2]["ok"]
    broken = plugins.answer(rows, "i", "t", extractor=lambda t: 1 / 0).collect()
    assert [r["answer"] for r in broken] == [None, None]
    assert one(spark, plugins.addresses(F.lit('"Doe, A" <A@x.ru>, b@y.ru (note)'))) == ["a@x.ru", "b@y.ru"]
    plugins.register_tables(spark)
    assert spark.sql("SELECT * FROM explode_phones('call 8 495 123-45-67 now')").first()["phone"] == "8 495 123-45-67"
    assert '"offer_number": "12/3"' in plugins.extract_offers("Offer No. 12/3, total 100 EUR")


def test_sections_and_range_export(spark, tmp_path):
    part = "array<struct<file_name:string,status:string,text:string,error:string>>"
    rows = spark.createDataFrame([("hello", [("a.zip", "excluded", None, None), ("b.docx", "saved", "txt", None), ("c.docx", "saved", None, "bad")])], f"body string, parts {part}")
    got = rows.select(mail.sectioned_text(F.col("body"), F.col("parts")).alias("t")).first()["t"]
    assert got == "=== BODY ===\nhello\n\n=== LEFT OUT ===\na.zip: excluded\n\n=== ATTACHMENTS ===\n[b.docx]\ntxt\n\n=== ERRORS ===\nc.docx: bad"
    spine = joins.date_spine(spark, "2024-01-01", "2024-01-02")
    results = spark.createDataFrame([(datetime.date(2024, 1, 2), 1), (datetime.date(2024, 2, 1), 2)], "day date, x int")
    assert {r["day"].day: r["ok"] for r in sinks.export_range(spine, results, str(tmp_path / "out")).collect()} == {1: False, 2: True}
    sinks.write_stats(results.agg(F.count("x").alias("n")), str(tmp_path / "stats"))
    sinks.write_tabs({"a": results}, str(tmp_path / "tabs"))
    sinks.write_tabs({"a": results}, str(tmp_path / "tabs"))
    assert spark.read.csv(str(tmp_path / "tabs/a"), header=True).count() == 4


def test_prompts_and_providers(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        config.prompt(spark, str(tmp_path / "none.txt"))
    (tmp_path / "p.txt").write_text("\n Say who wrote.\nIn JSON. \n")
    assert config.prompt(spark, str(tmp_path / "p.txt")) == "Say who wrote.\nIn JSON."
    (tmp_path / "bad.json").write_text("{")
    for path in ("none.json", "bad.json"):
        assert [(r["provider"], r["active"], r["failures_to_skip"]) for r in config.providers(spark, str(tmp_path / path), {"b": "k"}, ("a", "b")).collect()] == [("a", False, 3), ("b", True, 3)]
    (tmp_path / "good.json").write_text('{"provider_order": ["a", "b", "c"], "provider_settings": {"c": {"priority": 1, "retry_delay_seconds": 9}, "a": {"priority": 2}}}')
    got = config.providers(spark, str(tmp_path / "good.json"), {"a": "", "c": "k"})
    assert [(r["provider"], r["priority"], r["retry_seconds"], r["active"]) for r in got.collect()] == [("c", 1, 9.0, True), ("a", 2, 5.0, False), ("b", 4, 5.0, False)]
    failed = {1: [True, False, False], 3: [False, False, False]}
    for n, want in failed.items():
        assert [r["ok"] for r in got.select(config.usable(F.lit(n)).alias("ok")).collect()] == want


def test_paths_that_exist(spark):
    a = spark.createDataFrame([(1, ("x", "y", "z")), (2, (None, "y", None)), (3, ("n", None, "n")), (4, (None, None, None))], "id int, a struct<file_path:string,relative_path:string,saved_filename:string>")
    stored = spark.createDataFrame([("y",), ("y",), ("attachments/d/n",)], "path string")
    assert sorted(map(tuple, mail.existing_paths(a, "id", mail.possible_paths(F.col("a"), F.lit("d")), stored).collect())) == [(1, "y"), (2, "y"), (3, "attachments/d/n")]
