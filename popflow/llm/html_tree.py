"""A small tolerant HTML reader: elements with merged-tree paths, and text runs."""

from __future__ import annotations

import re

import xxhash

TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
LOOSE_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>")
ATTRIBUTE = re.compile(r"""([^\s=/"'<>]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""")
RAW = {x: re.compile(f"</{x}[^>]*>", re.I) for x in ("script", "style", "title", "textarea", "iframe", "noembed", "noframes")}

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp
small span strike strong sub sup time tt u var""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PROSE = HEADINGS | frozenset("p pre blockquote ul ol li dl dt dd table thead tbody tfoot tr td th caption figure figcaption".split())
#: What an open element of this kind ends at, and where the search for it stops.
ENDED_BY = {"li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
            "option": ({"option"}, {"select"})}
WALLS = frozenset("article main body td th table".split())

NOISE_TAGS = frozenset("""nav footer aside form script style noscript iframe svg button select template head menu dialog
object canvas title input textarea""".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
#: Words in a class or id that name page furniture.
NOISE_WORDS = frozenset("""nav navbar navigation menu breadcrumb breadcrumbs sidebar widget widgets footer header masthead banner ad ads
adv advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent notice notices gdpr popup
modal overlay newsletter subscribe subscription signup login search share sharing social related recommended recommendations
trending comment comments reply replies respond disqus discussion pagination pager copyright legal skip toolbar alert alerts
hidden teaser teasers byline""".split())
#: Names that a wrapper of the article itself never has.
SIDE_WORDS = frozenset("""comment comments reply replies respond disqus discussion related recommended recommendations trending
teaser teasers sponsor sponsored promo promotion popup modal newsletter""".split())
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


#: Levels of the tree; deeper elements count as their ancestor at the last one.
LEVELS = 64


class Page:
    """Elements in page order: parent, tag, path (hash of the tags, classes and places above and at it) and judgement by name.

    ``noise`` is 2 for furniture, 1 for a name that a wrapper of the article may have too, else 0.
    """

    def __init__(self):
        self.parent, self.tag, self.sig, self.path, self.noise, self.landmark = [-1], ["#"], ["#"], [0], [0], [False]
        self.runs: list[tuple[int, int, str]] = []  # element, block number, source text
        self.links: list[tuple[int, str]] = []

    def place(self) -> None:
        """Set the paths, once all elements are known.

        An element without class and id, prose and inline ones aside, is told
        from its like by its place among them, counted from the nearer end: so a
        bare page's header, body and footer are nodes of their own, and stay the
        same nodes when something comes between.
        """
        seen: dict[tuple[int, str], int] = {}
        bare = [self.sig[i] == self.tag[i] and self.tag[i] not in PROSE and self.tag[i] not in INLINE for i in range(len(self.tag))]
        number = [0] * len(self.tag)
        for i in range(1, len(self.tag)):
            if bare[i]:
                key = self.parent[i], self.tag[i]
                number[i] = seen[key] = seen.get(key, -1) + 1
        level = [0] * len(self.tag)
        for i in range(1, len(self.tag)):
            above = self.path[self.parent[i]]
            level[i] = level[self.parent[i]] + (self.tag[i] not in INLINE)
            if self.tag[i] in INLINE or level[i] > LEVELS:
                self.path.append(above)
                continue
            sig = self.sig[i]
            if bare[i]:
                before, behind = number[i], seen[self.parent[i], self.tag[i]] + 1 - number[i]
                sig = f"{sig}#{before if before < behind else -behind}"
            self.path.append(xxhash.xxh64_intdigest(sig, above) >> 1)

    def add(self, parent: int, tag: str, attributes: str) -> int:
        found, sig = {}, tag
        if attributes and not attributes.isspace():
            found = {k.lower(): (v or "").strip("\"'") for k, v in ATTRIBUTE.findall(attributes)}
            names = f"{found.get('class', '')} {found.get('id', '')}"
            if not names.isspace():
                sig = tag + "." + re.sub(r"\d+", "N", " ".join(sorted(names.split())))
        else:
            names = ""
        words = {w.lower() for w in WORD.findall(names)}
        role = found.get("role", "").lower()
        landmark = tag in ("article", "main") or role == "main" or found.get("itemprop") == "articleBody"
        sure = (tag in NOISE_TAGS or role in NOISE_ROLES or bool(words & SIDE_WORDS) or "hidden" in found
                or found.get("aria-hidden") == "true" or bool(HIDDEN.search(found.get("style", ""))))
        noise = 2 if sure else int(tag == "header" or bool(words & NOISE_WORDS))
        self.parent.append(parent)
        self.tag.append(tag)
        self.sig.append(sig)
        self.noise.append(noise)
        self.landmark.append(landmark)
        if tag == "a" and found.get("href"):
            self.links.append((len(self.tag) - 1, found["href"]))
        return len(self.tag) - 1


def parse(html: str) -> Page:
    page, stack, block, i, n = Page(), [0], 0, 0, len(html)
    tags = page.tag

    def pop_through(names, stops) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if tags[stack[k]] in names:
                del stack[k:]
                return
            if tags[stack[k]] in stops or tags[stack[k]] in WALLS:
                return

    while i < n:
        j = html.find("<", i)
        if j < 0:
            page.runs.append((stack[-1], block, html[i:]))
            break
        if j > i:
            page.runs.append((stack[-1], block, html[i:j]))
        if html.startswith("<!--", j):
            end = html.find("-->", j + 4)
            i = n if end < 0 else end + 3
            continue
        m = TAG.match(html, j) or LOOSE_TAG.match(html, j)
        if m is None:
            after = html[j + 1:j + 2]
            if after and (after in "!?/" or after.isascii() and after.isalpha()):
                end = html.find(">", j)
                i = n if end < 0 else end + 1
            else:
                page.runs.append((stack[-1], block, "<"))
                i = j + 1
            continue
        closing, name, attributes = m.groups()
        i, name = m.end(), name.lower()
        inline = name in INLINE
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                open_ = tags[stack[k]]
                if open_ == name:
                    del stack[k:]
                    break
                if inline and open_ not in INLINE or open_ in WALLS and name not in ("article", "main", "body", "html", "table"):
                    break
            block += not inline
            continue
        if name == "br" or name == "wbr":
            page.runs.append((stack[-1], block, " " if name == "br" else ""))
            continue
        if not inline:
            block += 1
            if name in ENDED_BY:
                pop_through(*ENDED_BY[name])
            elif name not in VOID:
                for k in range(len(stack) - 1, 0, -1):
                    if tags[stack[k]] == "p":
                        del stack[k:]
                        break
                    if tags[stack[k]] not in INLINE:
                        break
        at = page.add(stack[-1], name, attributes)
        if name in RAW:
            end = RAW[name].search(html, i)
            i = n if end is None else end.end()
        elif name not in VOID and not (attributes.endswith("/") and name in ("svg", "path")):
            stack.append(at)
    page.place()
    return page
