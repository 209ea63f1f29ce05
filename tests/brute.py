"""Plain restatements of the definitions, one conversation at a time."""

PUNCTUATION = ".,!?;:"
APOSTROPHES = "'’"


def clean(text):
    """Character by character: runs of whitespace are decided by what follows."""
    if text is None:
        return None
    out = []
    at = 0
    while at < len(text):
        if not text[at].isspace():
            out.append(text[at])
            at += 1
            continue
        end = at
        while end < len(text) and text[end].isspace():
            end += 1
        following = text[end] if end < len(text) else ""
        if following and following in PUNCTUATION:
            at = end
        elif following and following in APOSTROPHES:
            out.append(following)
            at = end + 1
            while at < len(text) and text[at].isspace():
                at += 1
        else:
            out.append(" ")
            at = end
    mapped = {"’": "'", "“": '"', "”": '"'}
    return "".join(mapped.get(c, c) for c in out).strip(" ")


def prepare(texts, lo=2, hi=500, least=2):
    kept = []
    for text in texts:
        cleaned = clean(text)
        if cleaned is None or not lo <= len(cleaned) <= hi:
            break
        kept.append(cleaned)
    if len(kept) % 2:
        kept.pop()
    if len(kept) < max(least, 2):
        return []
    return [("user" if i % 2 == 0 else "model", t) for i, t in enumerate(kept)]


def render(messages, opener=False):
    text = "<bos>"
    for role, content in messages:
        text += "<start_of_turn>" + role + "\n" + content.strip() + "<end_of_turn>\n"
    return text + ("<start_of_turn>model\n" if opener else "")


def fold(rows):
    """``rows`` of one session in order; yields (segment, pos, seq, history)."""
    segment, history = 0, []
    for seq, role, line in rows:
        line = (line or "").strip()
        if role == "user" and line == "/exit":
            return
        if role == "user" and line == "/reset":
            segment, history = segment + 1, []
            continue
        if role == "user" and not line:
            continue
        history = [*history, (role, line)]
        yield segment, len(history) - 1, seq, history
