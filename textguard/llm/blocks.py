"""Text blocks of a web page: a tokenizer that never looks back.

Runs inside tasks, one page at a time, in one pass over the page. It knows no document
tree: a stack of open elements is enough to tell which text belongs to a menu, an advert,
a form or another part that is never main text, and which to the article. Classification is
left to Spark (``textguard.llm.extraction``). The module is pickled by value.
"""

from __future__ import annotations

import html
import re
import sys
from collections import Counter
from collections.abc import Iterator

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Element names of HTML by what they do to text.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HARD_PARTS = frozenset("nav footer aside template dialog menu".split())
CHROME = HARD_PARTS | frozenset(
    "form noscript svg math button select option datalist label object audio video canvas map".split()
)
BREAKS = frozenset(
    "address article aside blockquote body caption center dd details dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main nav ol optgroup option p pre section "
    "summary table tbody td tfoot th thead tr ul".split()
)
ARTICLE = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words of class and id names, and roles, that mark parts beside the text.
BESIDE = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies disqus footer header login masthead menu modal nav navbar navigation newsletter notice "
    "pagination paywall popup promo promoted promotion related respond search share sharing sidebar signup "
    "skip social sponsor sponsored subscribe subscription toolbar widget widgets".split()
)
BESIDE_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status toolbar".split()
)

NAME = re.compile(r"[A-Za-z][^\s/>]*")
ATTRIBUTE = re.compile(r"""[\s/]*([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']*)))?""")
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
BLANKS = re.compile(r"\s+")
FEW_PARTS = 3


def attributes(tag: str) -> dict[str, str]:
    """The attributes after the tag's name; the first of a name holds."""
    out: dict[str, str] = {}
    for name, double, single, bare in ATTRIBUTE.findall(tag):
        out.setdefault(name.lower(), html.unescape(double or single or bare))
    return out


def beside(names: dict[str, str]) -> bool:
    """Whether class, id or role name a part beside the text. Of long compound names only the
    first and the last word count, so that ``post-with-sidebar-left`` is no sidebar."""
    if names.get("role", "").lower() in BESIDE_ROLES:
        return True
    if names.get("aria-hidden") == "true" or "hidden" in names:
        return True
    style = names.get("style", "").replace(" ", "").lower()
    if "display:none" in style or "visibility:hidden" in style:
        return True
    for name in (names.get("class", "") + " " + names.get("id", "")).split():
        parts = [part.lower() for part in PARTS.findall(name)]
        if parts[:1] in (["no"], ["has"], ["with"], ["without"]):
            continue
        if len(parts) <= FEW_PARTS and any(part in BESIDE for part in (*parts[:1], *parts[-1:])):
            return True
    return False


def commented(names: dict[str, str]) -> bool:
    """Whether an article is a reader's comment or another part beside the text; only whole
    names count, since articles carry names such as ``ad-free`` or ``share-open``."""
    whole = (names.get("class", "") + " " + names.get("id", "")).lower().split()
    return "hidden" in names or any(name in BESIDE or name.startswith("comment") for name in whole)


def tag_end(page: str, at: int) -> int:
    """The place of the ``>`` that ends a tag, past quoted values; the page's end if none does.

    An open quote that never ends does not swallow the page: the tag then ends at its first ``>``.
    """
    plain = page.find(">", at)
    if plain < 0:
        return len(page)
    place, stop = at, plain
    while True:
        quotes = [q for q in (page.find('="', place, stop), page.find("='", place, stop)) if q >= 0]
        if not quotes:
            return stop
        begin = min(quotes) + 1
        close = page.find(page[begin], begin + 1)
        if close < 0:
            return plain
        place = close + 1
        if place > stop:
            stop = page.find(">", place)
            if stop < 0:
                return plain


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """("text", "", text), ("open", name, tag), ("close", name, "") in page order.

    Comments, declarations and the content of scripts, styles and the like are left out. What
    is opened and never closed reaches to the end of the page, as in a browser.
    """
    at, size = 0, len(page)
    lowered: str | None = None
    while at < size:
        begin = page.find("<", at)
        if begin < 0:
            yield "text", "", page[at:]
            return
        after = page[begin + 1 : begin + 2]
        closing = after == "/"
        named = NAME.match(page, begin + 1 + closing)
        if not named and after not in ("!", "?", "/"):
            # A lone sign is text.
            yield "text", "", page[at : begin + 1]
            at = begin + 1
            continue
        if begin > at:
            yield "text", "", page[at:begin]
        if page.startswith("<!--", begin):
            end = page.find("-->", begin + 2)
            at = size if end < 0 else end + 3
            continue
        if not named:
            end = page.find(">", begin)
            at = size if end < 0 else end + 1
            continue
        name = named.group().lower()
        end = tag_end(page, named.end())
        at = end + 1
        if closing:
            yield "close", name, ""
            continue
        yield "open", name, page[named.end() : end]
        if name in RAW:
            if lowered is None:
                lowered = page.lower() if len(page.lower()) == size else _ascii_lower(page)
            stop = lowered.find(f"</{name}", at)
            at = size if stop < 0 else stop


def _ascii_lower(page: str) -> str:
    return page.translate({code: code + 32 for code in range(65, 91)})


VISIBLE, SOFT, HARD = range(3)
WORD = re.compile(r"[^\W\d_]+")


def page_blocks(page: str, stop_words: frozenset[str]) -> list[dict]:
    """The blocks of a page in order, parts beside the text left out.

    Per block: ``text`` with references decoded and white space as single spaces, whether it
    is ``inside`` an article and a ``heading``, the length of its text ``linked``, the number
    of its ``words`` and of ``stops`` among them. A header within an article gives its
    headings only. The first article of a page is read even where an element before it, a
    form or one named after a part beside the text, was never closed.
    """
    out: list[dict] = []
    # Open containers: name, and what held before it: hidden, inside, header.
    stack: list[tuple[str, int, bool, bool]] = []
    opened: Counter[str] = Counter()
    pieces: list[str] = []
    linked: list[str] = []
    hidden, inside, header = VISIBLE, False, False
    link = heading = met = False

    def flush() -> None:
        text = _plain(pieces)
        if text:
            words = WORD.findall(text.lower())
            out.append(
                {
                    "text": text,
                    "inside": inside,
                    "heading": heading,
                    "linked": len(_plain(linked)),
                    "words": len(words),
                    "stops": sum(map(stop_words.__contains__, words)),
                }
            )
        pieces.clear()
        linked.clear()

    for kind, name, body in tokens(page):
        if kind == "text":
            if not hidden and (heading or not header):
                pieces.append(body)
                if link:
                    linked.append(body)
            continue
        if name in BREAKS or name in CHROME:
            flush()
            heading = kind == "open" and name in HEADINGS
        elif name == "br":
            pieces.append(" ")
        if name == "a":
            link = kind == "open"
        if kind == "close":
            if opened[name]:
                while True:
                    last, hidden, inside, header = stack.pop()
                    opened[last] -= 1
                    if last == name:
                        break
            continue
        if name in VOID or name in RAW:
            continue
        if name in BREAKS and stack and stack[-1][0] == "p":
            _, hidden, inside, header = stack.pop()
            opened["p"] -= 1
        before = (hidden, inside, header)
        names = attributes(body) if body.strip(" /") else {}
        article = name in ARTICLE or names.get("role", "").lower() in ARTICLE
        if article and (name == "main" or not met) and hidden == SOFT:
            hidden = VISIBLE
        if not hidden and name not in ("html", "body"):
            if name in HARD_PARTS:
                hidden = HARD
            elif article:
                hidden = SOFT if commented(names) else VISIBLE
                inside, header = True, False
            elif name in CHROME or (names and beside(names)):
                hidden = SOFT
            elif name == "header":
                hidden, header = (VISIBLE, True) if inside else (HARD, False)
            met = met or (article and not hidden)
        if before != (hidden, inside, header) or (name in BREAKS and name not in HEADINGS and name != "p"):
            stack.append((name, *before))
            opened[name] += 1
    flush()
    return out


def _plain(parts: list[str]) -> str:
    return BLANKS.sub(" ", html.unescape("".join(parts))).strip() if parts else ""
