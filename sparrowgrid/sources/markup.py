"""HTML as a flat list of events: what every reader of pages starts from."""

from __future__ import annotations

from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np

# Elements without an end, and elements whose content is not shown.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INERT = {"script", "style", "template", "textarea", "pre", "code", "noscript", "title", "iframe", "xmp", "noembed", "noframes", "plaintext"}


class Event(NamedTuple):
    kind: str
    tag: str
    text: str
    attributes: list[tuple[str, str | None]]

    def get(self, name: str) -> str:
        """An attribute, empty if it is missing; the last of several counts."""
        return dict(self.attributes).get(name) or ""


class Malformed(ValueError):
    """The rest of the text can't be read; what came before is in ``events``."""

    def __init__(self, events: list[Event]):
        super().__init__("malformed markup")
        self.events = events


def events(text: str, most: int | None = None) -> list[Event]:
    """Elements opened and closed, texts, and other markup, in order. With ``most``, reading stops soon after so many."""
    out: list[Event] = []

    class Reader(HTMLParser):
        def handle_starttag(self, tag, attrs):
            out.append(Event("open", tag, "", attrs))

        def handle_endtag(self, tag):
            out.append(Event("close", tag, "", []))

        def handle_data(self, data):
            out.append(Event("text", "", data, []))

        def handle_startendtag(self, tag, attrs):
            out.append(Event("both", tag, "", attrs))

        def handle_comment(self, data):
            out.append(Event("other", "", "", []))

        handle_decl = handle_pi = unknown_decl = handle_comment

    reader = Reader(convert_charrefs=True)
    try:
        # In pieces, so that a bound on events holds while a long text is read.
        for at in range(0, len(text), 1 << 16):
            reader.feed(text[at : at + (1 << 16)])
            if most is not None and len(out) > most:
                return out
        reader.close()
    except (AssertionError, ValueError, RecursionError):
        raise Malformed(out) from None
    return out


def marks(found: list[Event], test) -> np.ndarray:
    return np.fromiter(map(test, found), bool, len(found))


def inside(opened: np.ndarray, closed: np.ndarray) -> np.ndarray:
    """For each event, whether the last mark up to it is an opening one."""
    place = np.arange(1, len(opened) + 1)
    last = lambda m: np.maximum.accumulate(np.where(m, place, 0)) if len(m) else place
    return last(opened) > last(closed)


def nested(opened: np.ndarray, closed: np.ndarray) -> np.ndarray:
    """For each event, whether more marks opened than closed; closings without an opening don't count."""
    depth = np.cumsum(opened.astype(np.int64) - closed)
    return depth > np.minimum(np.minimum.accumulate(depth), 0) if len(depth) else opened
