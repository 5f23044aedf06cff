"""Leaf blocks of a web page: runs of text between block borders, with what their ancestors and their text look like.

One pass over the markup by one regular expression, so that broken pages end as well: unclosed tags, quotes, comments
and scripts, stray end tags, markup inside scripts. A block element ends an open paragraph; an end tag closes
everything above its element, and is passed over if that is not open. Line breaks and inline elements do not end a block.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable
from html import unescape

# Element names by their role in HTML.
BORDERS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup p pre search section summary table tbody td tfoot "
    "th thead tr ul".split())
VOID = frozenset("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes noscript script style textarea title xmp".split())        # their content is no markup
MUTE = frozenset("audio button canvas datalist object option select svg template video".split())   # their text is no text of the page
SPACE = frozenset("br wbr img input td th".split())
# An element of the first kind ends an open one of the second kind.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
        "option": {"option"}, "tbody": {"tr", "td", "th"}}
HOLDS = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "tbody": {"table"},
         "option": {"select"}}

TOKEN = re.compile(r"""<!--(?:>|->|.*?(?:-->|\Z))|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|(?!["'])))*+)(?P<closed>>|\Z)?|<[!?/][^>]*+>?""",
                   re.S)
ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role|data-main|hidden|style)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?(?=[\s/"']|$)""", re.I)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_raw_end = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*+>?", re.I) for name in RAW}


def stems(value: str) -> set[str]:
    """The words of a name, each without a plural s."""
    return {w[:-1] if len(w) > 2 and w.endswith("s") and not w.endswith("ss") else w for w in (p.lower() for p in PART.findall(value))}


class Block:
    __slots__ = ("text", "features", "parent", "main")

    def __init__(self, text, features, parent, main):
        self.text, self.features, self.parent, self.main = text, features, parent, main


def _told(text: str, linked: int) -> list[str]:
    """What a block's text looks like."""
    n, words = len(text), text.count(" ") + 1
    share = linked / n
    commas = text.count(",") + text.count(";")
    told = [f"long:{min(n.bit_length(), 12)}", f"words:{min(words.bit_length(), 8)}", f"link:{0 if not share else 1 if share < 0.3 else 2 if share < 0.9 else 3}",
            f"end:{'stop' if text[-1] in '.!?…' else 'colon' if text[-1] in ':;,' else 'none'}", f"commas:{min(commas, 3)}"]
    if words > 12 and text[-1] in ".!?…\"»”" and share < 0.3:
        told.append("prose")
    if "©" in text or "(c)" in text.lower():
        told.append("copyright")
    if sum(map(str.isdigit, text)) * 4 > n:
        told.append("digits")
    if "|" in text or "»" in text or "·" in text or "›" in text:
        told.append("separators")
    return told


def blocks(html: str | None, known: Callable[[str], object] | None = None) -> list[Block]:
    """The blocks in page order. `known` gives a feature's number, or None for one to leave out; without it features stay strings.

    `main` says whether an element around the block carries the attribute data-main (labelled pages), and none
    inside that carries data-main="no".
    """
    number = known or (lambda name: name)
    html = html or ""
    out: list[Block] = []
    stack: list[tuple[str, tuple, object]] = []        # name, numbers of features, marked main or not
    open_names, active, marks = Counter(), Counter(), [False]
    pieces: list[str] = []
    state = {"linked": 0, "h1": False}
    parents = [(0, 0)]                                 # the nearest block element's number, and that of the one around it
    seen = 0

    def flush():
        text = " ".join("".join(pieces).split())
        pieces.clear()
        if text:
            own = [f"own:{next((s[0] for s in reversed(stack) if s[0] in BORDERS), 'none')}", *_told(text, min(state["linked"], len(text)))]
            if state["h1"]:
                own.append("after h1")
            numbers = [x for x in map(number, own) if x is not None]
            out.append(Block(text, [*active, *numbers], parents[-1][1], marks[-1]))
            state["h1"] = state["h1"] or bool(open_names["h1"])
        state["linked"] = 0

    def push(name, attrs):
        nonlocal seen
        found, mark = {f"in:{name}"} if name in BORDERS else set(), None
        for key, value in ATTRIBUTE.findall(attrs) if attrs.strip(" \t\n/") else ():
            key, value = key.lower(), value.strip("\"'")
            if key == "data-main":
                mark = value != "no"
            elif key == "hidden" or key == "style" and re.search(r"display\s*:\s*none", value):
                found.add("hidden")
            elif key != "style":
                found |= {f"named:{s}" for s in stems(unescape(value))}
        numbers = tuple(x for x in map(number, found) if x is not None)
        active.update(numbers)
        open_names[name] += 1
        stack.append((name, numbers, mark))
        if name in BORDERS:
            seen += 1
        parents.append((seen, parents[-1][0]) if name in BORDERS else parents[-1])
        marks.append(marks[-1] if mark is None else mark)

    def remove(at):
        name, numbers, _ = stack.pop(at)
        for x in numbers:
            active[x] -= 1
            if not active[x]:
                del active[x]
        open_names[name] -= 1
        parents.pop(at + 1), marks.pop(at + 1)

    def close(names, holders=frozenset()):
        """Closes up to the nearest open element of these names, unless one that holds them stands before it; an inline
        element closes alone, whatever was opened since."""
        for at in range(len(stack) - 1, -1, -1):
            if stack[at][0] in names:
                if stack[at][0] in BORDERS or stack[at][0] in MUTE:
                    while len(stack) > at + 1:
                        remove(len(stack) - 1)
                remove(at)
                return
            if stack[at][0] in holders:
                return

    def text(piece):
        if piece and not any(open_names[m] for m in MUTE):
            decoded = unescape(piece) if "&" in piece else piece
            pieces.append(decoded)
            if open_names["a"]:
                state["linked"] += len(decoded)

    at, size = 0, len(html)
    while at < size:
        token = TOKEN.search(html, at)
        if not token:
            text(html[at:])
            break
        text(html[at:token.start()])
        at = token.end()
        name = token["name"]
        if name is None:
            continue
        name = name.lower()
        if not token["closed"]:                        # the page ends inside a tag
            break
        if name in BORDERS:
            flush()
        elif name in SPACE:
            pieces.append(" ")
        if token["end"]:
            if name == "p" and not open_names["p"]:
                continue
            if open_names[name]:
                close({name})
            continue
        if name in BORDERS and open_names["p"]:
            close({"p"})
        if name in ENDS and any(open_names[x] for x in ENDS[name]):
            while any(open_names[x] for x in ENDS[name]):
                before = len(stack)
                close(ENDS[name], HOLDS[name])
                if len(stack) == before:
                    break
        if name in VOID:
            continue
        if name in RAW:
            end = _raw_end[name].search(html, at)
            at = end.end() if end else size
            continue
        push(name, token["attrs"])
    flush()
    return out
