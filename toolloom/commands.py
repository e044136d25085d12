"""Shell scripts from the tagged commands of a README."""

from __future__ import annotations

import os
import re

FENCE = re.compile(r"^\s*```bash.*?\n(.*?)^\s*```", re.M | re.S)
# The tags, by a part of the word behind `#` (the misspelt one counts as well), and the lines of a script.
TAGS = {"online": "online", "full": "full", "single": "single", "signle": "single"}


def tag_of(line: str) -> str | None:
    """full, single, online or test for a comment whose first word says so."""
    word = re.match(r"#\s*([A-Za-z]+)", line.strip())
    if word is None:
        return None
    low = word[1].lower()
    return "test" if low == "test" else next((t for part, t in TAGS.items() if part in low), None)


def commands(readme: str) -> dict[str, list[str]]:
    """Commands of python by tag (full and single).  A tag holds until the next one or the end of its block; test clears it.

    A command goes on to the next blank line or comment.
    """
    out: dict[str, list[str]] = {"full": [], "single": []}
    for fenced in FENCE.findall(readme):
        tag, held = None, None
        for line in map(str.strip, [*fenced.split("\n"), ""]):
            if held is not None and line and not line.startswith("#"):
                held.append(line)
                continue
            if held is not None:
                out[tag].append("\n".join(held))
                held = None
            if found := tag_of(line):
                tag = None if found == "test" else found
            elif tag in out and re.match(r"python3? ", line):
                held = [line]
    return out


HEAD, NONE = "#!/bin/bash\nset -euo pipefail", "# No commands detected for this mode."


def script(found: list[str]) -> str:
    return "\n\n".join([HEAD, *(found or [NONE])]).rstrip() + "\n"


def write_scripts(readme: str, full: str, single: str) -> dict[str, int]:
    """Write both scripts, executable; how many commands each has."""
    with open(readme, encoding="utf-8") as f:
        found = commands(f.read())
    for tag, path in (("full", full), ("single", single)):
        os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
        with open(path, "w", encoding="utf-8") as f:
            f.write(script(found[tag]))
        os.chmod(path, os.stat(path).st_mode | 0o111)
    return {k: len(v) for k, v in found.items()}
