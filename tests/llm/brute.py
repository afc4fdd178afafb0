"""Plain versions of the contracts, one text at a time, by other means than the operators."""

import base64
import hashlib
import re
import struct
from collections import Counter

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return WORDS.findall((text or "").translate(UPPER))


def op1(text):
    w = words(text)
    phrases = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
    places = [
        (i, label)
        for phrase, label in phrases.items()
        for i in range(len(w))
        if w[i : i + len(phrase.split())] == phrase.split()
    ]
    at = [i for i, _ in places]
    return {
        "n_words": len(w),
        "n_base": len(at),
        "first_word": min(at, default=None),
        "last_word": max(at, default=None),
        "base_labels": ",".join(sorted({x for _, x in places})),
    }


def op3(text, benchmark):
    w = words(text)
    hit, items = set(), set()
    for item, item_text in benchmark:
        iw = words(item_text)
        size = min(10, len(iw))
        windows = {tuple(iw[i : i + size]) for i in range(max(1, len(iw) - 9))} if iw else set()
        for i in range(len(w) - size + 1 if windows else 0):
            if tuple(w[i : i + size]) in windows:
                hit.update(range(i, i + size))
                items.add("" if item is None else str(item))
    return {
        "n_words": len(w),
        "n_hit": len(hit),
        "n_items": len(items),
        "items_sha256": sha(",".join(sorted(items))),
        "contaminated": bool(hit),
    }


def spans_digest(spans):
    return sha(",".join(f"{k}:{a}:{b}" for k, a, b in spans))


def op5(text):
    text = text or ""
    assign = re.compile(
        r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|"""
        r"""(?:[sS][eE][cC][rR][eE][tT])|(?:[tT][oO][kK][eE][nN])|(?:[aA][pP][iI]_?[kK][eE][yY]))"""
        r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    )
    found = {
        "assign": [m for m in assign.finditer(text) if len(m[2]) >= 12],
        "access": [m for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18],
        "hex": [m for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16],
    }
    order = list(found)
    spans = sorted(
        ((k, *m.span()) for k, ms in found.items() for m in ms), key=lambda s: (s[1], order.index(s[0]))
    )
    return {f"n_{k}": len(v) for k, v in found.items()} | {"base_sha256": spans_digest(spans)}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def op6(text):
    text = text or ""

    def digits(m):
        return re.sub("[^0-9]", "", m[0])

    find = re.finditer
    found = {
        "email": list(find(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)),
        "ip": [
            m
            for m in find(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))
        ],
        "card": [
            m
            for m in find(r"[0-9]([\x20-]?[0-9])+", text)
            if 16 <= len(digits(m)) <= 19 and luhn(digits(m))
        ],
        "phone": [m for m in find(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(digits(m)) <= 15],
    }
    spans = [(k, *m.span()) for k, ms in found.items() for m in ms]
    return {f"n_{k}": len(v) for k, v in found.items()} | {"base_sha256": spans_digest(spans)}


def op7(text, tokenizer):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    return {
        "n_tokens": len(ids),
        "ids_sha256": hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
        "decoded_sha256": sha(tokenizer.decode(ids, skip_special_tokens=False)),
    }


def op8(turns):
    """``turns``: (role, text) in order."""
    learned = "".join(t or "" for r, t in turns if r == "assistant")
    return {
        "n_turns": len(turns),
        "turns_sha256": sha("".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)),
        "loss_chars": len(learned),
        "loss_sha256": sha(learned),
    }


def op9(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(w, w[1:], w[2:]))
    again = set()
    for i, x in enumerate(zip(w, w[1:], w[2:])):
        if windows[x] > 1:
            again |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": dup,
        "n_repeat_words": len(again),
        "base_failed": len(w) < 50 or 100 * len(again) > 50 * len(w),
    }


def op10(pages):
    """``pages``: (page_id, html)."""
    first = {}
    for page, html in pages:
        first[html or ""] = min(page, first.get(html or "", page))
    return {
        page: {
            "payload_bytes": len((html or "").encode()),
            "payload_digest": base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode(),
            "record_type": "response" if first[html or ""] == page else "revisit",
            "refers_to": None if first[html or ""] == page else first[html or ""],
        }
        for page, html in pages
    }
