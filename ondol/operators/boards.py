"""Board layouts: declarative parsers of detail pages (one page, one row) and of list pages (one page, many rows).

A layout names selectors in the order in which they are tried; a registry of layouts is the extension point. Pages run in
Arrow batches; a page that can't be parsed gives a row with ``error`` set.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dom

DETAIL = "title_ko string, body_ko string, raw_price string, raw_location string, raw_posted_at string, contact_block string, source_listing_id string, error string"
ROWS = "url string, source_listing_id string, title string, location string, raw_date string"


@dataclass(frozen=True)
class Layout:
    """Selectors and labels of a board.

    Detail pages: ``cut`` and ``suffix`` trim the title; ``body_lines`` takes the body line by line, tables left out; ``fields``
    are selectors of single values that count before labels; ``meta`` is the place of a table of label and value cells, its
    values are taken by ``price_labels``, ``location_labels`` and ``contact_labels`` without labels in the body;
    ``lines`` are (label, selector) of a body put together of values; ``contacts`` are (prefix, label) of contact lines.
    List pages: ``row``, ``link``, ``row_title``, ``row_date`` (a selector, or the number of a cell, negative from the end),
    ``dates`` the rows of a second pass that only give dates, ``untitled`` the title of rows without one (None: left out).
    """

    title: tuple[str, ...] = ("h1", "h2", ".subj", "#cont > strong", "title")
    body: tuple[str, ...] = ("article section", ".detail", "#cont", "main", "body")
    date: tuple[str, ...] = ("time", ".date")
    listing_id: str = r"/(\w+)(?:[?#].*)?$"
    price_labels: tuple[str, ...] = ("월세", "보증금", "전세", "가격", "Rent")
    all_prices: bool = False
    location_labels: tuple[str, ...] = ("지역", "위치", "주소")
    date_labels: tuple[str, ...] = ("작성일", "등록일", "Posted", "Date", "날짜", "게시", "올린 시각")
    contact_labels: tuple[str, ...] = ("연락처", "이메일", "카카오", "전화", "Contact")
    infer: bool = False
    cut: str = ""
    suffix: str = ""
    body_lines: bool = False
    meta: str = ""
    fields: tuple[tuple[str, tuple[str, ...]], ...] = ()
    lines: tuple[tuple[str, str], ...] = ()
    contacts: tuple[tuple[str, str], ...] = ()
    row: str = "li"
    link: str = "a[href]"
    row_title: str = ""
    row_date: str | int = ".date"
    row_date_label: str = ""
    dates: str = ""
    untitled: str | None = ""
    drop_parameters: tuple[str, ...] = ("page",)


_PRICES, _DATES, _CONTACTS = ("월세", "보증금", "전세", "Rent"), ("작성일", "Posted", "Date"), ("연락처", "이메일", "카카오", "Contact")
_LABELLED = {"price_labels": _PRICES, "all_prices": True, "location_labels": ("지역", "위치"), "date_labels": _DATES, "contact_labels": _CONTACTS, "infer": True, "date": (), "suffix": r"\s*\|[^|]*$"}

#: Selectors, labels and patterns of addresses of six kinds of board software. New boards are new entries.
REGISTRY: dict[str, Layout] = {
    "default": Layout(),
    "meta_table": Layout(
        title=("h1#bo_v_title",), body=("#bo_v_con",), body_lines=True, date=("time",), date_labels=(), listing_id=r"/rent_housing/(\d+)", meta="#bo_v_atc", price_labels=("가격",),
        location_labels=("지역/위치", "위치"), contact_labels=(), contacts=(("전화: ", "전화"), ("이메일: ", "이메일")), row="li.d-md-table-row", link="a.na-subject", row_date="span.list_etc", row_date_label="등록일",
    ),
    "labelled_lines": Layout(
        title=("#bo_v_tit", "#bo_v_atc_title", "#hd_h1", ".view_title", "title"), cut=" > ", body=("#bo_v_atc #bo_v_con", "#bo_v_atc", "#bo_v_con", ".view_content", "body"), listing_id=r"wr_id=(\d+)",
        row="div.bo_tit", link="a[href*=wr_id]", row_date="span.bo_dt", **_LABELLED,
    ),
    "read_content": Layout(
        title=("#readcontent h1", "#readcontent h2", ".submenu_view h2", ".post_detail h1", "h1", "title"), body=("#readcontent", ".submenu_view", ".post_detail .content", "body"), listing_id=r"idx=([^&]+)",
        row="a[href*=board_read.asp]", link="", dates="table.board_list tbody tr", row_date=-1, untitled=None, **_LABELLED,
    ),
    "portal": Layout(
        title=(".realestate_over h1", "#contents-left-center h1", ".realestate_view h1", "h1", "title"), body=(".realestate_over", "#contents-left-center", ".realestate_view .view_content", "body"), listing_id=r"wr_id=(\d+)",
        row=".board_list li:not(.notice)", link="a.thumb", row_title=".subject h3", row_date=".date", **_LABELLED,
    ),
    "content_view": Layout(
        title=(".kboard-title h1", "h1"), body=(".kboard-content .content-view", ".kboard-content"), listing_id=r"uid=(\d+)", fields=(("raw_posted_at", (".detail-attr.detail-date",)),),
        row="tbody > tr:not(.kboard-list-notice)", link="td.kboard-list-title a[href*=mod=document]", row_date="td.kboard-list-date", drop_parameters=("pageid",), **(_LABELLED | {"location_labels": ("지역", "위치", "주소")}),
    ),
    "value_ids": Layout(
        title=("#MainContent_lbl_title",), body=(), listing_id=r"[?&]data=([^&#]+)", price_labels=(), location_labels=(), date_labels=(), contact_labels=(), date=(),
        fields=(("raw_price", ("#MainContent_lbl_pay", "#MainContent_lbl_pay2")), ("raw_posted_at", ("#MainContent_lbl_boardregdate",)), ("raw_location", ("#MainContent_lbl_city, #MainContent_lbl_state",))),
        lines=(("형태", "#MainContent_lbl_joblist"), ("Bedrooms", "#MainContent_lbl_bedroom"), ("Bathrooms", "#MainContent_lbl_bathroom"), ("크기", "#MainContent_lbl_sq")),
        contacts=(("전화: ", "#MainContent_lbl_telnum"), ("작성자: ", "#MainContent_lbl_writer"), ("회사: ", "#MainContent_lbl_companyname")),
        row="a[href*=/ad_rent/rentview?data=]", link="", dates="table.table_board_2 tbody tr", row_date=4, untitled="Listing {}",
    ),
}
#: Values of a made-up body that say nothing.
NOTHING = {"", "0", "0 sq ft"}


def first_text(root: dom.Element, selectors: tuple[str, ...]) -> str:
    """The text of the first selector whose first element has one."""
    for s in selectors:
        e = root.first(s)
        if e is not None and (t := e.text()):
            return t
    return ""


def body_text(root: dom.Element, selectors: tuple[str, ...]) -> str:
    """Of the first selector with an element: its p and div children in lines, else its whole text."""
    for s in selectors:
        e = root.first(s)
        if e is not None:
            parts = [c.text() for c in e.children if isinstance(c, dom.Element) and c.tag in ("p", "div")]
            return "\n".join(p for p in parts if p) or e.text()
    return ""


def labelled(text: str, labels: tuple[str, ...]) -> str:
    for line in text.splitlines():
        for label in labels:
            for sep in (":", "："):
                if line.strip().startswith(label + sep):
                    return line.strip()[len(label) + 1 :].strip()
    return ""


def cells(root: dom.Element) -> dict[str, str]:
    """Label cell -> value cell, the first two of a row; the last of repeated labels counts."""
    out = {}
    for tr in root.select("tr"):
        tds = [c for c in tr.children if isinstance(c, dom.Element) and c.tag in ("td", "th")]
        if len(tds) >= 2:
            out[tds[0].text().rstrip(":： ")] = tds[1].text()
    return out


def _lines(e: dom.Element) -> str:
    """The texts of an element one a line, tables left out."""

    def walk(x: dom.Element) -> Iterator[str]:
        for c in x.children:
            if isinstance(c, str):
                yield c.strip()
            elif c.tag not in ("table", "script", "style"):
                yield from walk(c)

    return "\n".join(x for x in walk(e) if x)


def _infer(title: str, body: str, labelled_: str) -> str:
    """The labelled place; else the title's bracket with the first body line, unless the line holds it; else either."""
    bracket = m[1] if (m := re.match(r"\s*\[\s*([^\]]+?)\s*\]", title)) else ""
    head = next((x.strip() for x in body.splitlines() if x.strip()), "")
    return labelled_ or (f"{bracket} {head}" if bracket and head and bracket not in head else head or bracket)


def detail(html: str, url: str, layout: Layout) -> dict[str, str]:
    root = dom.parse(html)
    title = first_text(root, layout.title)
    if layout.cut:
        title = title.split(layout.cut)[0].strip()
    title = re.sub(layout.suffix, "", title) if layout.suffix else title
    if layout.lines:
        values = [(label, first_text(root, (s,))) for label, s in layout.lines]
        body = "\n".join([title, *[f"{label}: {v}" for label, v in values if v not in NOTHING]]).strip()
    elif layout.body_lines:
        body = next((_lines(e) for s in layout.body if (e := root.first(s)) is not None), "")
    else:
        body = body_text(root, layout.body)
    place = root.first(layout.meta) if layout.meta else root
    table = cells(place) if place is not None else {}
    single = {k: " ".join(dict.fromkeys(t for s in selectors for e in root.select(s) if (t := e.text()))) if "," in selectors[0] else first_text(root, selectors) for k, selectors in layout.fields}
    if "raw_location" in single:
        single["raw_location"] = ", ".join(t for e in root.select(dict(layout.fields)["raw_location"][0]) if (t := e.text()))
    pick = lambda labels: next((table[k] for k in labels if table.get(k)), "") or (labelled(body, labels) if not layout.meta else "")
    stamp = next((e.attrs.get("datetime") or e.text() for s in layout.date for e in root.select(s)), "")
    spans = [e.text() for e in root.select("span")] if layout.date else []
    after = next((spans[k + 1] for k, s in enumerate(spans[:-1]) if s.rstrip(":") in layout.date_labels), "")
    date = re.sub(r"^작성일:?\s*", "", single.get("raw_posted_at", "")) or stamp or after or labelled(body, layout.date_labels)
    price = "\n".join(v for k in layout.price_labels if (v := labelled(body, (k,)))) if layout.all_prices else pick(layout.price_labels)
    location = pick(layout.location_labels)
    contact = [p + v for p, k in layout.contacts if (v := first_text(root, (k,)) if k.startswith("#") else table.get(k, ""))]
    found = re.search(layout.listing_id, url or "")
    return {
        "title_ko": title, "body_ko": body, "raw_price": single.get("raw_price") or price, "raw_location": single.get("raw_location") or (_infer(title, body, location) if layout.infer else location),
        "raw_posted_at": date, "contact_block": "\n".join(contact) or pick(layout.contact_labels), "source_listing_id": found[1] if found else "",
    }


def contact_block(root: dom.Element | None) -> str:
    """The text of an element that holds contacts, empty without one."""
    return root.text() if root is not None else ""


def parse_details(pages: DataFrame, board: str | None = None) -> DataFrame:
    """Adds the DETAIL columns to pages (url, html_content and a column ``board`` unless one is given). NULL pages give empty
    texts; an unknown board or a failing page sets ``error``."""

    @F.pandas_udf(f"struct<{DETAIL.replace(' string', ':string')}>")
    def run(html: pd.Series, url: pd.Series, name: pd.Series) -> pd.DataFrame:
        rows = []
        for h, u, b in zip(html, url, name):
            try:
                rows.append(detail(h or "", u or "", REGISTRY[b]) | {"error": None})
            except Exception as e:  # a page must not end the job
                rows.append({k.split()[0]: "" for k in DETAIL.split(", ")} | {"error": f"{type(e).__name__}: {e}"})
        return pd.DataFrame(rows, columns=[k.split()[0] for k in DETAIL.split(", ")])

    name = F.lit(board) if board else F.col("board")
    return pages.withColumn("_d", run("html_content", "url", name)).select("*", "_d.*").drop("_d")


def _address(a: dom.Element, base: str, layout: Layout) -> str:
    url = a.attrs.get("href", "")
    if not re.match("https?://", url):
        url = base.rstrip("/") + "/" + url.lstrip("/")
    for p in layout.drop_parameters:
        url = re.sub(rf"([?&]){p}=[^&#]*&?", r"\1", url).rstrip("?&")
    return url


def _row_date(row: dom.Element, layout: Layout) -> str:
    if isinstance(layout.row_date, int):
        tds = row.select("td")
        enough = len(tds) >= 3 if layout.row_date < 0 else len(tds) > layout.row_date
        return tds[layout.row_date].text() if enough else ""
    e = row.first(layout.row_date)
    return e.text().removeprefix(layout.row_date_label).strip() if e is not None else ""


def list_rows(html: str, base: str, layout: Layout) -> Iterator[tuple[str, str, str, str, str]]:
    """(url, id, title, bracketed place, date text) of a list page; of repeated ids the first URL and the first title that isn't
    empty count. With ``dates`` the rows of that selector only give the dates, joined by the id of their link."""
    root = dom.parse(html)
    seen: dict[str, list[str]] = {}

    def id_of(url: str) -> str | None:
        found = re.search(layout.listing_id, url)
        return found[1] if found else None

    for row in root.select(layout.row):
        a = row.first(layout.link) if layout.link else row
        if a is None or not (key := id_of(url := _address(a, base, layout))):
            continue
        title = first_text(row, (layout.row_title,)) if layout.row_title else a.text()
        old = seen.setdefault(key, [url, title, "" if layout.dates else _row_date(row, layout)])
        old[1] = old[1] or title
        old[2] = old[2] or ("" if layout.dates else _row_date(row, layout))
    for row in root.select(layout.dates) if layout.dates else ():
        for a in row.select(layout.row):
            if (key := id_of(_address(a, base, layout))) in seen:
                seen[key][2] = seen[key][2] or _row_date(row, layout)
    for key, (url, title, date) in seen.items():
        if not title and layout.untitled is None:
            continue
        title = title or layout.untitled.format(key)
        place = re.match(r"\s*\[\s*([^\]]+?)\s*\]", title)
        yield url, key, title, place[1] if place else "", date


def parse_lists(pages: DataFrame, board: str = "default", layout: Layout | None = None) -> DataFrame:
    """ROWS of list pages (url, html_content), one page to many rows."""
    chosen = layout or REGISTRY[board]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [r for h, u in zip(pdf.html_content, pdf.url) if h for r in list_rows(h, re.match(r"^(?:https?://)?[^/]*", u or "")[0], chosen)]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in ROWS.split(", ")])

    return pages.select("url", "html_content").mapInPandas(run, ROWS)
