"""A hand-written archive site and the segment rows it must give."""

import datetime as dt

SITE = "https://news.example.org"
EARLY = dt.datetime(2025, 1, 1)
LATE = dt.datetime(2025, 1, 2)


def page(kind, path, html, status=200, at=EARLY):
    tail = path.rsplit("/", 1)[-1]
    return (kind, int(tail) if tail.isdigit() else None, SITE + path, status, html, at)


def segment(info, title, description, meta):
    return (
        f'<html><body><p class="broadcast-info">{info}</p><h4 class="video-title">{title}</h4>'
        f'<div class="video-description">{description}</div>{meta}</body></html>'
    )


def meta(label, *entries):
    return f'<dl class="video-meta">{"".join(entries)}</dl>'.replace("LABEL", label)


PROGRAM_1 = '<a href="/programs/1">p</a>'
PAGES = [
    page(
        "index",
        "/siteindex/",
        '<table class="broadcastindex"><tr><td><a href="/siteindex/2024-1">a</a></td>'
        '<td><a href="/siteindex/2024-11">b</a><td><a>no href</a><p><a href="/deep/2024-2">x</a></p>'
        '<td><a href="undated">c</a><td><a href="/siteindex/2024-1">again</a>'
        '<td><a href="/siteindex/2023-05">landed with an error</a></table>'
        '<table class="other"><td><a href="/siteindex/2024-3">no</a></table>',
    ),
    page(
        "month",
        "/siteindex/2024-1",
        '<ul><li class="elist_segment"><a href="/broadcasts/11">11</a>'
        '<li class="elist_segment"><a href="/broadcasts/12">12</a>'
        '<li class="elist_segment"><a href="/broadcasts/21">21</a>'
        '<li class="elist_segment"><a href="/broadcasts/11">11 again</a>'
        '<li class="slist_segment"><a href="/broadcasts/91">91</a>'
        '<li class="slist_segment"><a href="https://elsewhere.example.com/broadcasts/5">f</a>'
        '<li class="slist_segment more"><a href="/broadcasts/92">wrong class</a></ul>',
    ),
    page(
        "month",
        "/siteindex/2024-11",
        '<li class="elist_segment"><a href="/broadcasts/31">31</a>'
        '<li class="elist_segment"><a href="/broadcasts/41">no program</a>'
        '<li class="slist_segment"><a href="../broadcasts/92">92</a>'
        '<li class="slist_segment"><a href="/broadcasts/special">no id</a>',
    ),
    page("month", "/siteindex/undated", '<li class="slist_segment"><a href="/broadcasts/93">93</a>'),
    page("month", "/siteindex/2023-05", '<li class="slist_segment"><a href="/broadcasts/92">92</a>', 500),
    page(
        "program",
        "/programs/1",
        '<h4 class="program-headline"> ABC Evening News for Monday </h4>'
        '<p class="program-duration">This program is about 1 hour long.</p><ul>'
        '<li class="listing"><p class="id"><em>1</em></p><p class="timestamp"> 05:30 pm — 05:31 pm '
        '</p><a href="/broadcasts/11">a</a>'
        '<li class="listing"><p class="id"><em>2</em></p><p class="timestamp">05:31 pm — 05:32 pm'
        '</p><a href="/broadcasts/12">b</a>'
        '<li class="listing"><p class="id"><em>3</em></p><p class="timestamp">05:32 pm — 05:33 pm'
        '</p><a href="/broadcasts/11">first one again</a>'
        '<li class="listing"><p class="id"><em>4</em></p><p class="timestamp">05:33 pm — 05:34 pm'
        '</p><a href="/broadcasts/19">not landed</a></ul>',
    ),
    page(
        "program",
        "/programs/2",
        '<h4 class="program-headline">CBS</h4><p class="program-duration"> 25 min </p>'
        '<div class="listing"><p class="id"><em>no</em></p></div>'
        '<li class="listing item"><p class="id x"><em>1</em></p><a href="/broadcasts/21">a</a>'
        '<li class="listing"><p class="id"><em>2</em></p><p class="timestamp">10:00</p>'
        '<a href="/broadcasts/22">not in a month list</a>',
    ),
    page(
        "broadcast",
        "/broadcasts/11",
        segment("old", "old", "<p>old</p>", ""),
    ),
    page(
        "broadcast",
        "/broadcasts/11",
        segment(
            f"ABC for Monday, Jan 01, 2024 {PROGRAM_1} for more",
            " Storm\xa0",
            "outside<p>(Studio) One &amp; two </p>between<p>REPORTER: <b>Ann Doe</b></p>",
            meta(
                "Reporter(s):",
                "<dt>Duration:</dt><dd>00:01:00</dd>",
                "<dt>LABEL</dt><dd>Doe, Ann;</dd><dd>Roe, Bo</dd>",
            ),
        ),
        at=LATE,
    ),
    page(
        "broadcast",
        "/broadcasts/12",
        segment(
            f"\n{PROGRAM_1} for Monday, Jan 01, 2024",
            "Sport",
            "<p>[Man&amp;nbsp- says]</p>",
            "<dt>Duration:</dt><dd>00:02:00</dd>"
            + meta("Reporters:", "<dt>LABEL</dt><dd>Not, Evening</dd>"),
        ),
    ),
    page(
        "broadcast",
        "/broadcasts/21",
        segment('CBS for Tuesday <a href="/programs/2">p</a>', "Mail", "", ""),
    ),
    page("broadcast", "/broadcasts/22", segment("CBS for Tuesday", "Rail", "", "")),
    page(
        "broadcast",
        "/broadcasts/31",
        segment('NBC for Friday <a href="/programs/3">not landed</a>', "Lost", "", ""),
    ),
    page("broadcast", "/broadcasts/41", segment("NBC for Friday", "No link", "", "")),
    page(
        "broadcast",
        "/broadcasts/91",
        segment(
            " FNC Special for Show for Thursday, Dec 16, 2004 ",
            "Speech, \"quoted\"",
            "<p>Line one\nand two</p>",
            meta(
                "Reporters:",
                "<dt>LABEL<dd>Doe, Ann<dd>00:09:00<dt>Duration:<dd>00:09:00",
            ),
        ),
    ),
    page("broadcast", "/broadcasts/92", segment("no separator", "", "", "")),
    page(
        "broadcast",
        "/broadcasts/93",
        segment("A for B", "Elsewhere", "", "<dl><dt>Duration:</dt><dd>1</dd></dl>"),
    ),
    page("broadcast", "/broadcasts/special", segment("A for B", "No id", "", "")),
]

# date, program_title, program_duration, broadcast_title, broadcast_duration,
# broadcast_time, broadcast_order, broadcast_abstract, broadcast_reporter(s)
ABC = ("ABC Evening News", "about 1 hour")
STORM = "(Studio) One & twoREPORTER:Ann Doe"
EVENING_1 = [
    ("Monday, Jan 01, 2024", *ABC, "Storm", "00:01:00", "05:30 pm-05:31 pm", 11, STORM,
     "Doe, Ann;Roe, Bo"),
    (None, *ABC, "Sport", "00:02:00", "05:31 pm-05:32 pm", 12, "[Man&nbsp- says]", ""),
    ("Monday, Jan 01, 2024", *ABC, "Storm", "00:01:00", "05:32 pm-05:33 pm", 11, STORM,
     "Doe, Ann;Roe, Bo"),
    (None, *ABC, "", "", "05:33 pm-05:34 pm", 19, "", ""),
    ("Tuesday", "CBS", "25 min", "Mail", "", "10:00", 21, "", ""),
]
SPECIAL_1 = [
    ("Thursday, Dec 16, 2004", "FNC Special", "", "Speech, \"quoted\"", "00:09:00", "", 91,
     "Line one\nand two", "Doe, Ann"),
]
SPECIAL_11 = [("", "", "", "", "", "", 92, "", "")]
UNDATED = [("B", "A", "", "Elsewhere", "", "", 93, "", "")]
EXPECTED = EVENING_1 + SPECIAL_1 + SPECIAL_11 + UNDATED
