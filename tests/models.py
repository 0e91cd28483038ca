"""Plain Python models of the operators, to check small inputs by brute force."""

import base64
import hashlib
import re

# Fixed value: a definition header at the start of a stripped line.
HEADER = re.compile(r"(?:class\s+\w+\s*\(?[^)]*\)?:|def\s+\w+\s*\(?[^)]*\)?:)")
KEY = "my_super_secret_key_for_paths"


def sha(text):
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def cut(lines, starts):
    ends = starts[1:] + [len(lines)]
    return ["".join(lines[a:b]) for a, b in zip(starts, ends)]


def line_chunks(text, header=HEADER):
    if not text.strip():
        return []
    lines = text.splitlines(keepends=True)
    starts = [i for i, line in enumerate(lines) if i == 0 or header.match(line.strip())]
    return cut(lines, starts)


def top_level_chunks(text, header=HEADER):
    if not text.strip():
        return []
    lines = text.splitlines(keepends=True)
    starts = []
    for i, line in enumerate(lines):
        if header.match(line):
            first = i
            while first > 0 and lines[first - 1][0] in "@#":
                first -= 1
            starts.append(first)
    preamble = [x.strip() for x in lines[: starts[0]]] if starts else []
    if not starts or any(x and x[0] not in "@#" for x in preamble):
        starts = sorted({0, *starts})
    else:
        starts[0] = 0
    return cut(lines, starts)


def root(hashes):
    level = list(hashes)
    while len(level) > 1:
        if len(level) % 2:
            level.append(level[-1])
        level = [sha(a + b) for a, b in zip(level[::2], level[1::2])]
    return level[0] if level else None


def spans(chunks):
    """(start_line, end_line, true_start, true_end) of each chunk."""
    out, reported, true = [], 1, 1
    for c in chunks:
        newlines, lines = c.count("\n"), len(c.splitlines())
        out.append((reported, reported + newlines, true, true + lines - 1))
        reported, true = reported + newlines + 1, true + lines
    return out


def pseudonym(path, key=KEY):
    digest = hashlib.sha256(key.encode()).digest()
    hide = lambda s: bytes(b ^ digest[i % 32] for i, b in enumerate(s.encode("utf-8")))
    return "/".join(base64.urlsafe_b64encode(hide(s)).decode() for s in (path or "").split("/"))


def index(path, text, known=(), key=KEY):
    """(chunk_index, embedding_id, lines, status) rows of one file."""
    chunks, hidden = line_chunks(text), pseudonym(path, key)
    cached = root([sha(c) for c in chunks]) in known
    rows = []
    for i, (c, (start, end, _, _)) in enumerate(zip(chunks, spans(chunks))):
        if cached:
            rows.append((i, sha(f"{c}{hidden}{i}")[:16], None, "cached"))
        elif "erro" in c.lower():
            rows.append((i, None, f"{start}-{end}", "failed"))
        else:
            rows.append((i, sha(f"{c}{hidden}{start}{end}")[:16], f"{start}-{end}", "processed"))
    return rows
