"""Plain versions of what the operators compute."""

import collections
import html.parser
import math
import re

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def ngrams(text, n=5):
    w = words(text)
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def jaccard_groups(docs, threshold=0.8):
    """Group (least id) and number of links of each document, by all pairs that share an n-gram."""
    sets = {d: ngrams(t) for d, t in docs}
    holders = collections.defaultdict(list)
    for d, s in sets.items():
        for g in s:
            holders[g].append(d)
    shared = collections.Counter((a, b) for x in holders.values() for i, a in enumerate(x) for b in x[i + 1 :])
    root, links = {d: d for d in sets}, collections.Counter()

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), n in shared.items():
        if n >= threshold * (len(sets[a]) + len(sets[b]) - n):
            links[a] += 1
            links[b] += 1
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {d: find(d) for d in sets}, links, None


def hits(text, items, size=10):
    """Number of words, places hit, items found."""
    w = words(text)
    places, found = set(), set()
    for item, t in items:
        iw = words(t)
        n = min(size, len(iw))
        windows = {tuple(iw[i : i + n]) for i in range(len(iw) - n + 1)} if n else set()
        for i in range(len(w) - n + 1 if n else 0):
            if tuple(w[i : i + n]) in windows:
                places |= set(range(i, i + n))
                found.add(item)
    return len(w), places, found


def base_spans(text):
    """Spans of personal data straight from the patterns."""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        if 14 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d[::-1])) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out)


def personal_data(docs, near=8, support=3, threshold=0.9, significance=9.0, cue_words=3):
    """Spans (start, kind, end) of each text: patterns, secrets (4) behind cues, disclosing terms (5); from the definitions, with no hashes."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    lower = lambda x: "".join(c.lower() if c < "\x80" else c for c in x)

    def random_like(x):
        n, count = len(x), collections.Counter(x.lower())
        mixed = sum((a.isdigit() and b.isalpha()) or (a.isalpha() and b.isdigit()) for a, b in zip(x, x[1:]))
        return mixed * 8 >= n and -sum(c / n * math.log2(c / n) for c in count.values()) >= 3

    def groups(kind, value):
        value, digits = value.lower(), re.sub("[^0-9]", "", value)
        more = [value.split("@")[-1]] if kind == 0 else [".".join(value.split(".")[:i]) for i in (2, 3)] if kind == 1 else []
        more += [digits[:6]] if kind == 2 else [digits[:-7]] if kind == 3 else []
        return [(kind,), (kind, "value", value), *[(kind, "group", x) for x in more]]

    spans, secrets, terms, n_words = {}, {}, {}, 0
    near_docs, n_e, contexts, n_t = collections.Counter(), collections.Counter(), collections.defaultdict(set), collections.Counter()
    for i, text in docs.items():
        spans[i] = base_spans(text)
        free = [m.span() for m in re.finditer(r"[A-Za-z0-9+/_-]{20,}", text) if random_like(m[0])]
        secrets[i] = [(a, 4, b) for a, b in free if all(b <= s or e <= a for s, _, e in spans[i])]
        terms[i] = [(m.start(), m.end(), lower(m[0])) for m in word.finditer(text)]
        n_words += len(terms[i])
        n_t.update({t for _, _, t in terms[i]})
        held, beside = set(), set()
        for a, kind, b in spans[i] + secrets[i]:
            front = [lower(m[0]) for m in word.finditer(text[max(0, a - 4000) : a])][-near:]
            back = [lower(m[0]) for m in word.finditer(text[b : b + 4000])][:near]
            for e in groups(kind, text[a:b]):
                held.add(e)
                for t in front + back:
                    beside.add((e, t))
                    contexts[e, t].add(tuple(front + back))
        n_e.update(held)
        near_docs.update(beside)
    places = collections.Counter()
    for (e, _), n in near_docs.items():
        places[e] += n
    cues, disclosing = set(), set()
    for (e, t), n in near_docs.items():
        p, surprise = n / n_t[t], -math.log(n_e[e] / len(docs))
        if len(contexts[e, t]) < support or not surprise or (math.log(p) + surprise) / surprise < threshold:
            continue
        if len(contexts[e, t]) * math.log(p / min(1, places[e] / n_words)) >= significance:
            disclosing.add(t)
            if e == (4,):
                cues.add(t)
    for i in docs:
        before = lambda a: [t for s, _, t in terms[i] if s < a][-cue_words:]  # noqa: E731, B023
        spans[i] += [x for x in secrets[i] if cues & set(before(x[0]))]
        spans[i] += [(a, 5, b) for a, b, t in terms[i] if t in disclosing and all(b <= s or e <= a for s, _, e in spans[i])]
        spans[i].sort()
    return spans


class _Blocks(html.parser.HTMLParser):
    """Lines of a simple page: blocks' texts with linked characters; what counts nothing leaves a window of empty lines."""

    def __init__(self, window):
        super().__init__(convert_charrefs=True)
        self.window, self.lines, self.text, self.linked, self.link, self.off = window, [], "", 0, False, []

    def end_block(self):
        if text := " ".join(self.text.split()):
            self.lines.append((text, self.linked))
        self.text, self.linked = "", 0

    def handle_starttag(self, tag, attrs):
        if self.off or tag in ("script", "style", "title", "nav", "footer") or ("class", "ad") in attrs:
            if not self.off:
                self.end_block()
            if not self.off or tag == self.off[0]:
                self.off.append(tag)
        elif tag == "br":
            self.text += " "
        elif tag == "a":
            self.link = True
        elif tag != "b":
            self.end_block()
            self.lines += [("", 0)] * (tag in ("div", "body"))

    def handle_endtag(self, tag):
        if self.off:
            if tag == self.off[0]:
                self.off.pop()
                if not self.off and tag not in ("script", "style", "title"):
                    self.lines += [("", 0)] * self.window
        elif tag == "a":
            self.link = False
        elif tag != "b":
            self.end_block()

    def handle_data(self, data):
        if not self.off:
            self.text += data
            self.linked += len(" ".join(data.split())) * self.link


def line_blocks(page, window, surge):
    """Main text of a simple page (nav, div, footer, links, paragraphs) from the definition of surge and dive."""
    parser = _Blocks(window)
    parser.feed(page)
    parser.end_block()
    lines = parser.lines
    size = [0 if 2 * n > len(t) else len(t) - n for t, n in lines]
    ahead = [sum(size[i : i + window]) for i in range(len(size))]
    least = min(surge, max(ahead, default=0) / 2)
    kept = set()
    for i in range(len(lines)):
        if size[i] and ahead[i] >= least:
            j = i
            while j >= 0 and ahead[j] >= least / 8:
                kept.add(j)
                j -= 1
            j = i
            while j < len(lines) and ahead[j]:
                kept.add(j)
                j += 1
    return "\n".join(lines[i][0] for i in sorted(kept) if size[i])
