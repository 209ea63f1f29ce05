"""Plain versions of the ten contracts; each returns "equal" or tells what differs."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import tiktoken
import xxhash
from tokenizers import Tokenizer


def sha(raw: str | bytes) -> str:
    return hashlib.sha256(raw.encode() if isinstance(raw, str) else raw).hexdigest()


def crc(ids) -> int:
    return zlib.crc32(np.asarray(ids, dtype="<u4").tobytes())


def differ(got: dict, want: dict):
    bad = [(k, got.get(k), want.get(k)) for k in want.keys() | got.keys() if got.get(k) != want.get(k)]
    return "equal" if not bad else ("differ", len(bad), bad[:3])


def english() -> Tokenizer:
    """As the library reads its file: the content of an added token is that token."""
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def op2_byte_bpe(got, docs):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {}
    for doc_id, text in docs:
        ids = enc.encode_ordinary(text or "")
        want[doc_id] = (len(ids), sha(",".join(map(str, ids))), sha(text or ""))
    return differ({r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got.itertuples()}, want)


def op3_fingerprints(got, docs):
    order = sorted(docs)
    want = {}
    for i, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        k = len(text) // 2
        want[doc_id] = (len(text), sha(text[: len(text) - k] + after[:k]))
    prints = defaultdict(set)
    for doc_id, text in order:
        prints[text or ""].add(got.loc[got.doc_id == doc_id, "fingerprint"].iloc[0])
    if any(len(p) > 1 for p in prints.values()):
        return "equal texts, different fingerprints"
    if len({next(iter(p)) for p in prints.values()}) != len(prints):
        return "different texts, equal fingerprints"
    return differ({r.doc_id: (r.n_chars, r.edited_sha256) for r in got.itertuples()}, want)


def simhash(text: str) -> int:
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode()))
    if not words:
        return 0
    runs = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = np.array([xxhash.xxh64_intdigest(r, 42) for r in runs], dtype=np.uint64)
    return sum(1 << b for b in range(64) if 2 * int(((hashes >> np.uint64(b)) & np.uint64(1)).sum()) > len(runs))


def groups(n: int, links) -> list[int]:
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def op4_simhash(got, docs):
    docs = sorted(docs)
    prints = np.array([simhash(t) for _, t in docs], dtype=np.uint64)
    links = []
    for i in range(len(docs)):
        links += [(i, i + 1 + int(j)) for j in np.flatnonzero(np.bitwise_count(prints[i + 1 :] ^ prints[i]) <= 3)]
    root = groups(len(docs), links)
    want = {d: (f"{int(p):016x}", docs[r][0]) for (d, _), p, r in zip(docs, prints, root, strict=True)}
    return differ({r.doc_id: (r.fingerprint, r.component_id) for r in got.itertuples()}, want)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


KINDS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
}


def base(text: str) -> list[tuple]:
    out = [(m.start(), i, m.end(), kind) for i, (kind, (pattern, ok)) in enumerate(KINDS.items()) for m in re.finditer(pattern, text or "") if ok(m.group())]
    return sorted(out)


def listed(spans) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)


def op7_pii(got, docs):
    want = {}
    for doc_id, text in docs:
        spans = base(text)
        want[doc_id] = (*[sum(s[3] == k for s in spans) for k in KINDS], sha(listed(spans)), True)
    told = {}
    text_of = dict(docs)
    for r in got.itertuples():
        spans = [s for s in r.spans.split(",") if s]
        whole = [s for s in spans if not s.startswith("term:")]
        starts = [(int(s.split(":")[1]), [*KINDS, "term"].index(s.split(":")[0])) for s in spans]
        ok = sha(",".join(whole)) == r.base_sha256 and starts == sorted(starts) and all(int(s.split(":")[2]) <= len(text_of[r.doc_id] or "") for s in spans)
        told[r.doc_id] = (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, ok)
    return differ(told, want)


def op8_packing(got, docs, window: int = 1024):
    tokenizer = english()
    ids = {d: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for d, t in docs}
    ends, sequences = defaultdict(list), defaultdict(list)
    for r in got.itertuples():
        if crc(ids[r.doc_id][r.start : r.start + r.length]) != r.ids_crc32 or r.doc_tokens != len(ids[r.doc_id]) or r.length < 1:
            return ("piece", r)
        ends[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for d, own in ids.items():
        at = 0
        for start, length in sorted(ends[d]):
            if start != at:
                return ("gap in document", d)
            at += length
        if at != len(own):
            return ("document not whole", d)
    for s, own in sequences.items():
        at = 0
        for offset, length in sorted(own):
            if offset != at:
                return ("gap in sequence", s)
            at += length
        if at > window or at & (at - 1):
            return ("padding", s, at)
    return "equal"


def op10_token_files(got, docs):
    tokenizer = english()
    want, at = {}, 0
    for doc_id, text in sorted(docs):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        want[doc_id] = (at, len(ids), crc(ids))
        at += len(ids)
    return differ({r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in got.itertuples()}, want)


def cut_words(text: str | None) -> list[str]:
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def all_runs(words: list, min_words: int = 12) -> list[tuple]:
    """(start, length, period), by comparing the words with themselves a period later."""
    found: dict[tuple, int] = {}
    n = len(words)
    for q in range(1, n // 2 + 1):
        start = None
        for i in range(n - q + 1):
            same = i + q < n and words[i] == words[i + q]
            if same and start is None:
                start = i
            elif not same and start is not None:
                if i - start + q >= max(min_words, 2 * q):
                    found.setdefault((start, i - start + q), q)
                start = None
    return sorted((s, length, q) for (s, length), q in found.items())


def op11_periodic_runs(got, docs):
    want = {}
    for doc_id, text in docs:
        words = cut_words(text)
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        runs = all_runs(words)
        lost = {i for s, length, q in runs for i in range(s + q, s + length)}
        top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        kept = " ".join(w for i, w in enumerate(words) if i not in lost)
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        want[doc_id] = (len(runs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None, sha(lines), sha(kept))
    whole = lambda v: None if v is None or v != v else int(v)
    told = {r.doc_id: (r.n_runs, *map(whole, (r.start, r.length, r.period, r.exponent_milli)), r.runs_sha256, r.collapsed_sha256) for r in got.itertuples()}
    return differ(told, want)


def edits(word: str, letters: str) -> set[str]:
    cuts = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    out = {a + b[1:] for a, b in cuts if b} | {a + c + b for a, b in cuts for c in letters} | {a + c + b[1:] for a, b in cuts if b for c in letters}
    return out - {word}


def variants_of(counts: dict[str, int]) -> dict[str, tuple]:
    letters = "".join(set("".join(counts)))
    form, near = {}, {}
    for word, n in counts.items():
        others = [(-counts[x], x) for x in edits(word, letters) if x in counts]
        best = min(others, default=None)
        near[word] = len(others)
        form[word] = best[1] if best and -best[0] >= 2 * n else None
    out = {}
    for word, n in counts.items():
        root = word
        while form[root]:
            root = form[root]
        out[word] = (form[word], root, n, near[word], counts.get(form[word]))
    return out


def op12_spelling_variants(got, docs):
    counts: dict[str, int] = defaultdict(int)
    for doc_id, text in docs:
        for word in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m.group().lower(), word)
            h = zlib.crc32(f"{doc_id}:{word}".encode())
            if h % 97 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    want = variants_of({w: n for w, n in counts.items() if len(w) >= 5 and n >= 3})
    some = lambda v: None if v is None or v != v else v
    return differ({r.word: (some(r.form), r.root, r.n, r.n_near, some(r.form_n)) for r in got.itertuples()}, want)


def op13_sharding(got, docs):
    want = {d: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), "rows") for d, t in docs}
    if len(got) != len(docs) or got.grown_shard.notna().any():
        return ("rows", len(got))
    slots = defaultdict(list)
    for r in got.itertuples():
        slots[r.shard].append(r.slot)
    if any(sorted(own) != list(range(len(own))) for own in slots.values()) or not set(slots) <= set(range(16)):
        return ("slots", dict(slots))
    counts = [len(slots[s]) for s in range(16)]
    if max(counts) - min(counts) > 1:
        return ("counts", counts)
    return differ({r.doc_id: (r.size, r.text_crc32, r.law) for r in got.itertuples()}, want)


def language_bits(rows: list[tuple], text: str) -> dict[str, float]:
    """Bits of the text under each language's contexts of two bytes, one and none, escapes by method C."""
    bits = {}
    for lang in sorted({lang for _, lang in rows}):
        seen: dict[bytes, dict[int, int]] = defaultdict(lambda: defaultdict(int))
        for own, of in rows:
            raw = b"\0\0" + own.encode()
            for i in range(2, len(raw) if of == lang else 0):
                for k in (2, 1, 0):
                    seen[raw[i - k : i]][raw[i]] += 1
        raw, total = b"\0\0" + text.encode(), 0.0
        for i in range(2, len(raw)):
            share = 1.0
            for k in (2, 1, 0, None):
                counts = {} if k is None else seen.get(raw[i - k : i], {})
                n, kinds = sum(counts.values()), len(counts)
                if k is None:
                    share /= 256
                elif raw[i] in counts:
                    share *= counts[raw[i]] / (n + kinds)
                    break
                elif n:
                    share *= kinds / (n + kinds)
            total -= float(np.log2(share))
        bits[lang] = total
    return bits


def cheapest_reading(cost, symbol, options, skips, repeat_cost: float, token: str) -> float:
    """The least cost over all readings of a token, tried one by one."""

    def go(i: int, a: int, b: int, last: str) -> float:
        if i == len(token):
            return float(cost[a, b, 0])
        best = skips(token[i]) + go(i + 1, a, b, last) if skips(token[i]) is not None else np.inf
        for letter, extra in options(token[i]):
            s = symbol(letter)
            best = min(best, extra + float(cost[a, b, s]) + go(i + 1, b, s, letter))
            if s and s == b and letter == last:
                best = min(best, extra + repeat_cost + go(i + 1, a, b, last))
        return best

    return go(0, 0, 0, "")
