"""HTTP clients without a network, for dry runs and tests: each is a callable ``get(url) -> (status, headers, body)``."""

from __future__ import annotations

import json
from urllib.parse import parse_qs, unquote, urlsplit

#: A small wiki: categories with their members, as many as ``PER_PAGE`` on a listing page.
CATEGORIES = {
    "Category:BanG Dream!": ["Category:Bands", "Category:Songs", "Overview"],
    "Category:Bands": [f"Band {i}" for i in range(7)] + ["Category:BanG Dream!"],
    "Category:Songs": [f"Song {i}" for i in range(4)] + ["Template:Song", "Band 0"],
}
PER_PAGE = 3
#: Titles whose batch answers have no text, and a title that no request gives.
EMPTY_IN_BATCH, GONE = ("Band 1", "Song 2"), "Song 3"


def image(url: str) -> tuple[int, dict, bytes]:
    return (404, {}, b"") if url.endswith("gone.png") else (200, {}, url.encode())


def wiki(url: str) -> tuple[int, dict, str]:
    parts = urlsplit(url)
    asked = parse_qs(parts.query)
    if "titles" in asked:
        return 200, {}, _answer(asked["titles"][0].split("|"))
    name = unquote(parts.path.rsplit("/", 1)[-1]).replace("_", " ")
    if name not in CATEGORIES:
        return 404, {}, ""
    members = sorted(CATEGORIES[name])
    start = next((i for i, m in enumerate(members) if m >= asked.get("pagefrom", [""])[0]), len(members))
    shown, rest = members[start : start + PER_PAGE], members[start + PER_PAGE :]
    subs = "".join(f'<a title="{m}">c</a>' for m in shown if m.startswith("Category:"))
    pages = "".join(f'<li><a href="/x" title="{m}">p</a></li>' for m in shown if not m.startswith("Category:"))
    more = f'<a href="/{name}?pagefrom={rest[0].replace(" ", "+")}">下一页</a>' if rest else ""
    return 200, {}, f'<div id="mw-subcategories">{subs}</div><div id="mw-pages"><ul>{pages}</ul></div>{more}'


def _answer(titles: list[str]) -> str:
    pages = {}
    for i, t in enumerate(titles):
        if t == GONE:
            pages[f"-{i + 1}"] = {"title": t, "missing": ""}
            continue
        text = "" if t in EMPTY_IN_BATCH and len(titles) > 1 else f"== {t} ==\nAbout {t}."
        pages[str(i + 1)] = {"title": t, "pageid": i + 1, "lastrevid": 10, "touched": "2026-01-02T03:04:05Z", "categories": [{"title": "Category:歌曲" if t.startswith("Song") else "Category:乐队"}], "extract": text}
    return json.dumps({"query": {"pages": pages}})
