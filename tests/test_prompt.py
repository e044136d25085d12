"""Questions by a model with retries, an endpoint, and scripts from a README."""

import json
import os
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

from toolloom import commands
from toolloom.operators import prompt

TASKS = "uuid string, message_index int, func string, description string, said string, schema string, answer_text string"


def good(answer):
    return "Here:\n```json\n" + json.dumps({"question": "Which?", "options": [answer, "b=2"], "answer": answer}) + "\n```"


def test_generate_retries_with_shorter_prompts(spark):
    rows = [(f"u{i}", i, "f", "d" * 900, "c" * 900, "{}", "a = 1") for i in range(5)]
    tasks = spark.createDataFrame(rows, TASKS)

    answered = good("a=1")  # a text: the test module is not on the workers

    def client():
        def ask(p):
            if "u" * 3 in p:
                raise ValueError("x" * 500)
            return answered if p.count("c") < 790 else "no object here"

        return ask

    done, failed = prompt.generate(tasks, client)
    assert done.count() == 5 and failed.count() == 0
    bad = lambda reply: prompt.generate(tasks.limit(2), lambda: lambda p: reply, retries=2)[1].collect()
    assert {(r["reason"], r["attempts"]) for r in bad("[1]")} == {("payload_not_dict", 2)}
    assert {r["reason"] for r in bad(good("a=2"))} == {"canonical_missing"}

    def broken():
        def ask(p):
            raise ValueError("x" * 500)

        return ask

    none, failed = prompt.generate(tasks, broken, retries=1)
    one = prompt.failures(failed, 3).first()
    assert none.count() == 0 and (one["reason"], one["failures"], len(one["samples"])) == ("request_failed", 5, 3) and len(one["samples"][0]["detail"]) == 200


def test_endpoint():
    seen = []

    class Handler(BaseHTTPRequestHandler):
        def reply(self, body):
            data = json.dumps(body).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(data)

        def do_GET(self):
            self.reply({"data": [{"id": "m1"}, {"id": "m2"}]})

        def do_POST(self):
            seen.append(json.loads(self.rfile.read(int(self.headers["Content-Length"]))))
            self.reply({"choices": [{"message": {"content": "hello"}}]})

        def log_message(self, *a):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}/v1"
    assert prompt.models(url) == ["m1", "m2"] and prompt.endpoint(url, system="s")()("hi") == "hello"
    assert seen[0]["model"] == "m1" and [m["role"] for m in seen[0]["messages"]] == ["system", "user"] and seen[0]["max_tokens"] == 512
    server.shutdown()
    assert prompt.signature()[1] == ""


README = """
python out.py
```bash
# full run
python a.py \\
  --x 1

# Signle
python3 b.py
# test
python c.py
# online only
python d.py
```
```bash
python e.py
# single
ls
python f.py
```
"""


def test_scripts_from_a_readme(tmp_path):
    assert commands.commands(README) == {"full": ["python a.py \\\n--x 1"], "single": ["python3 b.py", "python f.py"]}
    (tmp_path / "R.md").write_text(README)
    assert commands.write_scripts(str(tmp_path / "R.md"), str(tmp_path / "full.sh"), str(tmp_path / "s" / "single.sh")) == {"full": 1, "single": 2}
    assert os.access(tmp_path / "full.sh", os.X_OK) and (tmp_path / "s" / "single.sh").read_text().startswith("#!/bin/bash\nset -euo pipefail\n\npython3 b.py\n\npython f.py\n")
    assert "No commands" in commands.script([])
