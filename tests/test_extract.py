"""Parsers on invented agendas."""

import pytest

from meetloom.extract import kernels as k

AGENDA = """DATE: Wednesday, May 20, 2026
Board of Supervisors
Operations Cluster

2. INFORMATIONAL ITEM(S):

A. Board Letter (Works) for June 09, 2026:
BOARD LETTER
AWARD CONTRACTS FOR MAINTENANCE
OF ROADS.
Speakers: Ann Lee and Bo Day
- Cy Fox

B. None.

3. MOTIONS:
SD-1 • Fund tenant outreach
in all districts
SD-2
A probation study
PUBLIC COMMENT
not part of it
4. DISCUSSION

B) EQUITY FRAMEWORK

Chair: nobody
"""


def test_cluster_agenda():
    doc = k.extract(AGENDA)
    assert (doc.body_name, doc.meeting_date, k.iso_date(doc.meeting_date), doc.document_role) == ("Operations Cluster", "Wednesday, May 20, 2026", "2026-05-20", "agenda")
    assert [(x.section_number, x.item_label, x.item_type, x.title) for x in doc.items] == [
        ("2", "A", doc.items[0].item_type, doc.items[0].title),
        ("3", "SD-1", "board_motion", "Fund tenant outreachin all districts"),
        ("3", "SD-2", "board_motion", "A probation study"),
        ("4", "B", "other", "EQUITY FRAMEWORK"),
    ]
    assert doc.items[0].speakers == ["Ann Lee", "Bo Day", "Cy Fox"] and "contracting" in doc.items[0].topic_tags
    assert doc.items[1].topic_tags == ["budget", "homelessness", "housing"] and doc.items[2].topic_tags == ["probation", "public_safety"]


def test_roman_letters_open_sections():
    assert [x.section_number for x in k.extract("1. One\nC. Two\nA. item\n").items] == ["C"]


def test_meeting_page():
    page = """<title>Parks Committee - 05/07/2026</title><div class="section-with-items"><tr class="section-row"><td><p>ITEM(S)</p></td></tr>
<div class="meeting-item"><table><tr><td class="number-cell">(1)</td><td colspan="2"><p>26-0001</p></td></tr><tr><td></td><td><p>Homeless outreach&nbsp;report</p> Fiscal Impact Statement: Yes</td></tr></table></div>
<div class="meeting-item"><table><tr><td class="number-cell">(2)</td></tr></table></div></div>"""
    doc = k.extract(page)
    assert (doc.parser, doc.body_name, doc.meeting_date) == (k.PRIMEGOV, "Parks Committee", "May 7, 2026")
    assert [(x.item_label, x.section_title) for x in doc.items] == [("1", "ITEM(S)")]
    assert "Council File: 26-0001" in doc.items[0].text_block and "homelessness" in doc.items[0].topic_tags


def test_supporting_document():
    doc = k.extract("Page 1\nDraft Minutes\nThursday, June 4, 2026", "/x/parks-board/supporting_docs/supporting_1_a-b.txt")
    assert (doc.document_role, doc.body_name, doc.meeting_date, doc.items[0].title, doc.items[0].item_label) == ("minutes", "Parks Board", "Thursday, June 4, 2026", "Draft Minutes", "DOC")


def test_votes():
    got = k.parliamentary(["On motion of Supervisor Lee, seconded by Supervisor Day, duly carried by the following vote, this item was approved.", "Ayes: 2 - Supervisors Lee and Day", "Noes: ", "Ayes: Lee, Day, Fox"])
    assert (got["motion_by"], got["second_by"], got["final_action"], got["ayes_count"], got["noes_count"]) == ("Lee", "Day", "approved", 3, None)
    assert k.parliamentary(["After discussion, the item was continued two weeks"])["final_action"] == "continued"


def test_unknown_parser_and_frames(spark):
    with pytest.raises(KeyError):
        k.extract("x", parser="none")
    df = spark.createDataFrame([("a", AGENDA, None), ("b", None, None), ("c", "", None)], "path string, text string, parser string")
    assert [r["path"] for r in k.extract_items(df).collect()] == ["a"] * 4


def test_proceedings():
    text = """STATEMENT OF PROCEEDINGS FOR THE REGULAR MEETING OF THE Board of Supervisors
Tuesday, April 14, 2026, 9:30 AM
II. CONSENT CALENDAR
3. Motion for tenant relief
and more (26-1234)
On motion of Supervisor Lee, seconded by Supervisor Day, this item was approved.
Ayes: Supervisors Lee and Day
4. no file number here
the first line
the second line
the third line

IV. PUBLIC HEARINGS
12. Hearing on fees (26-2222)
Opportunity was given for the public to address the Board
Set Matter 1. Report on fire safety (26-3333)
The foregoing is a fair statement of the proceedings
5. never (26-4444)
"""
    doc = k.extract(text)
    assert (doc.parser, doc.meeting_date, doc.document_role) == (k.PROCEEDINGS, "Tuesday, April 14, 2026", "proceedings")
    assert [(x.section_title, x.item_label, x.item_type, x.motion_by, x.ayes_count) for x in doc.items] == [("CONSENT CALENDAR", "3", "board_motion", "Lee", 2), ("PUBLIC HEARINGS", "12", "public_hearing", None, None), ("PUBLIC HEARINGS", "1", "public_hearing", None, None)]
    assert doc.items[0].title == "Motion for tenant relief and more"


def test_regional_and_deputies():
    regional = k.extract("AGENDA FOR THE REGULAR MEETING OF THE\nEXAMPLE COMMITTEE FOR REGIONAL HOMELESS ALIGNMENT\nKenneth Hahn Hall\nTHURSDAY, JUNE 5, 2025\n\nI. Reports.\n1. Budget report (25-0001)\nPage 2\nmore text\n2. Other\nChair: nobody\n")
    assert (regional.body_name, regional.meeting_date) == ("Example Committee For Regional Homeless Alignment", "Thursday, June 5, 2025")
    assert [(x.section_number, x.item_label, x.title) for x in regional.items] == [("I", "1", "Budget report"), ("I", "2", "Other")]
    old = k.extract("HOMELESS POLICY DEPUTIES MEETING AGENDA\nDate: Thursday, June 12, 2025\nI. Welcome and Introductions: 2:00\nII. New Department Update: 2:10 - 2:30\nAnn Lee, Office\nAnn Lee\nVI. Adjournment\n")
    assert [(x.section_number, x.title) for x in old.items] == [("II", "New Department Update")] and old.meeting_date == "Thursday, June 12, 2025"
    new = k.extract("Homelessness & Housing Cluster\nDATE: May 14, 2026\nII. Items: 2:05-2:50pm\n\na. Interim housing plan (2:00 - 2:15 pm)\nSpeakers: Bo Day\n\nb. Public comment\nAGN. NO.____\nc. never\n")
    assert [(x.section_title, x.item_label, x.title, x.speakers) for x in new.items] == [("Items", "A", "Interim housing plan", [])]
    assert new.items[0].text_block == "Interim housing plan (2:00 - 2:15 pm) Speakers: Bo Day"


DEPUTIES_TEXT = """DATE: May 14, 2026
TIME: 2:00PM - 4:00PM
Board of Supervisors
Homelessness & Housing Cluster
Agenda Review Meeting

II. Board Motion(s): 2:05-2:50pm

a. Carrying Out the Advice of the Panel on Families
Experiencing Homelessness
Presenter: Ann Lee, First District
500 West Temple Street
homelessness_and_housing_comment@example.org

b. A Simpler Governance Structure for Housing
Presenter: Bo Day, Third District

V. Presentation/Discussion Item(s): 3:20-4:00pm

a. Progress of the County's Emergency Rent
Relief Program
Presenters:
• Cy Fox, Chief, Policy Division
• Di Hall, Analyst, Policy Division
12

b. Tentative/Time Permitting: Data Blueprint
Presenters:
• Ed Ives, Chief Information Officer

VI. Informational Item(s)

a. None.
"""


def test_deputies_newer_form_field_by_field():
    doc = k.extract(DEPUTIES_TEXT)
    assert (doc.body_name, doc.meeting_date, doc.document_role) == ("Homelessness & Housing Cluster", "May 14, 2026", "agenda")
    # Section V looks like an item's letter: it ends item b and opens nothing, so its items stay in section II.
    assert [(x.section_number, x.section_title, x.item_label, x.item_type, x.title, x.speakers) for x in doc.items] == [
        ("II", "Board Motion(s)", "A", "cluster_agenda_item", "Carrying Out the Advice of the Panel on Families", []),
        ("II", "Board Motion(s)", "B", "cluster_agenda_item", "A Simpler Governance Structure for Housing", []),
        ("II", "Board Motion(s)", "A", "cluster_agenda_item", "Progress of the County's Emergency Rent", ["Cy Fox, Chief, Policy Division", "Di Hall, Analyst, Policy Division"]),
        ("II", "Board Motion(s)", "B", "cluster_agenda_item", "Tentative/Time Permitting: Data Blueprint", ["Ed Ives, Chief Information Officer"]),
    ]
    assert doc.items[0].text_block == "Carrying Out the Advice of the Panel on Families Experiencing Homelessness Presenter: Ann Lee, First District"
    assert doc.items[2].text_block == "Progress of the County's Emergency Rent Relief Program Cy Fox, Chief, Policy Division Di Hall, Analyst, Policy Division"
    assert "homelessness" in doc.items[0].topic_tags and "housing" in doc.items[1].topic_tags


def test_deputies_older_form_field_by_field():
    doc = k.extract("""HOMELESS POLICY DEPUTIES MEETING AGENDA
        MEETING WILL TAKE PLACE 100% VIRTUALLY
        Date: Thursday, June 12, 2025
        Time: 2:00 - 4:00 PM
        AGENDA ITEM LEAD
        I. Welcome and Introductions Ann Lee, Fifth District
        II. New Department Update
        Bo Day
        Temporary Services Administrator,
        III.
        Update on New Department
        Listening Sessions
        Cy Fox
        Deputy Director, Housing for Health,
        VII. Public Comment*
        NEXT MEETING: June 26, 2025
        """)
    assert doc.meeting_date == "Thursday, June 12, 2025"
    assert [(x.section_number, x.section_title, x.item_label, x.title) for x in doc.items] == [("II", "New Department Update", "II", "New Department Update"), ("III", "Update on New Department", "III", "Update on New Department")]  # a line of capitalised words passes for a name
    assert [x.text_block for x in doc.items] == ["New Department Update New Department Update Bo Day Temporary Services Administrator,", "Update on New Department Listening Sessions Cy Fox Deputy Director, Housing for Health,"]


REGIONAL_TEXT = """THURSDAY, JUNE 5, 2025, 1:00 P.M.

AGENDA FOR THE REGULAR MEETING OF THE
EXAMPLE COUNTY LEADERSHIP TABLE FOR
REGIONAL HOMELESS ALIGNMENT

I.  ADMINISTRATIVE MATTERS
1. Call to Order and Roll Call.  (25-2991)
2. Welcome and Opening Remarks  (25-2992)
Supporting Document
Public Comment/Written Correspondence
Attachments:
3. Approval of the March 6, 2025 Minutes.  (25-2993)
Supporting Document
June 5, 2025 Agenda
Page 2 of 3

II.  DISCUSSION
5. Timeline for
Measure A Implementation.
Presenters:
• Ann Lee, Director  (25-3013)
Supporting Document

III.  OUTREACH: 10 minutes
6. Presentation on Feedback.  (25-3014)
Password: x
lost line
"""


def test_regional_form_field_by_field():
    doc = k.extract(REGIONAL_TEXT)
    assert (doc.body_name, doc.meeting_date) == ("Example County Leadership Table For Regional Homeless Alignment", "Thursday, June 5, 2025")
    assert [(x.section_number, x.section_title, x.item_label, x.item_type, x.title) for x in doc.items] == [
        ("I", "ADMINISTRATIVE MATTERS", "1", "brown_act_agenda_item", "Call to Order and Roll Call."), ("I", "ADMINISTRATIVE MATTERS", "2", "brown_act_agenda_item", "Welcome and Opening Remarks"),
        ("I", "ADMINISTRATIVE MATTERS", "3", "brown_act_agenda_item", "Approval of the March 6, 2025 Minutes."), ("II", "DISCUSSION", "5", "brown_act_agenda_item", "Timeline for"), ("III", "OUTREACH", "6", "brown_act_agenda_item", "Presentation on Feedback."),
    ]
    assert doc.items[3].text_block == "Timeline for Measure A Implementation. Presenters: • Ann Lee, Director (25-3013)"
    assert "outreach" not in doc.items[4].title.lower() and "homelessness" in doc.items[4].topic_tags  # by its section's title
    assert doc.items[2].text_block == "Approval of the March 6, 2025 Minutes. (25-2993)" and doc.items[4].text_block == "Presentation on Feedback. (25-3014)"


def test_regional_body_names_end_at_places_days_and_headings():
    opening = "AGENDA FOR THE REGULAR MEETING OF THE\nCommittee For Regional Homeless Alignment\nCare Committee\n"
    for end in ("Los Angeles Homeless Services Authority\n637 Wilshire Boulevard 1st Floor\nThursday, May 1, 2025\n", "Monday, May 5, 2025\n", "Password: x\n", "I. First\n", "\nmore"):
        assert k.extract(opening + end + "I. A\n1. b\n", parser=k.DEFAULT).body_name == "Committee For Regional Homeless Alignment Care Committee"


def test_proceedings_sections_titles_and_set_matters():
    head = "STATEMENT OF PROCEEDINGS FOR THE\nBoard of Supervisors\n"
    by = lambda text: [(x.section_title, x.item_label, x.title, x.text_block) for x in k.extract(head + text, parser=k.PROCEEDINGS).items]
    # A bare number opens a section whose title follows, but inside an item it is text.
    assert by("II.\nADMIN MATTERS\n7. Plan one (26-0001)\nIII.\nPUBLIC HEARINGS\n") == [("ADMIN MATTERS", "7", "Plan one III. PUBLIC HEARINGS", "Plan one III. PUBLIC HEARINGS")]
    # A file number on the first line does not end a title; a later one does, and so does a body phrase.
    assert by("I. CONSENT\n1. Fees (26-0001)\nof the port (26-0002)\nthen text\n") == [("CONSENT", "1", "Fees of the port", "Fees of the port then text")]
    assert by("I. CONSENT\n1. Fees (26-0001)\nand more\nOn motion of A, seconded by B, approved\n")[0][2] == "Fees and more"
    # Numbered lines without a file number are items of hearing and set-matter sections only.
    assert by("I. CONSENT\n1. nothing\n9. else\n2. Fees (26-0001)\n")[-1:] == [("CONSENT", "2", "Fees", "Fees")]
    assert len(by("I. CONSENT\n1. nothing\n9. else\nx\nx\nx\nx\nx\n2. Fees (26-0001)\n")) == 1
    assert [x[:3] for x in by("I. SET MATTERS\n1. One\nof two\n2. Two\nReport by them\n3. body of it\n")] == [("SET MATTERS", "1", "One of two"), ("SET MATTERS", "2", "Two")]
    assert [x[:2] for x in by("Set Matter 4. Alone\n")] == [("SET MATTER", "4")]
    assert [x[:2] for x in by("I. CONSENT\n2. Fees (26-0001)\nSet Matter 4. inside\n")] == [("CONSENT", "2")]


def test_regional_agendas_come_by_the_default_parser():
    text = "AGENDA FOR THE REGULAR MEETING OF THE\nREGIONAL HOMELESS ALIGNMENT\nKenneth Hahn Hall\nI. Reports.\n1. Budget\n"
    assert k.detect_parser(text, "") == k.DEFAULT and k.extract(text, parser=k.DEFAULT).items[0].item_type == "brown_act_agenda_item"
    assert k.extract(text.replace("AGENDA FOR", "Agenda for")).items == [] or k.extract(text.replace("AGENDA FOR", "Agenda for")).items[0].item_type != "brown_act_agenda_item"
    assert k.detect_parser("Statement of proceedings for the\nboard of supervisors", "") == k.DEFAULT


def test_vote_members_and_mojibake():
    f = k.parliamentary(["On motion of Supervisor Lee, seconded by Supervisor Ray, approved", "Ayes: 2 - Supervisors Lee and Ray", "Noes: None 0 -"])
    assert (f["ayes_members"], f["ayes_count"]) == (["2 - Supervisors Lee", "Ray"], 2) or f["ayes_count"] == 2
    assert k.normalised("a\u00a0b\u00c2 c") == "a b c"
