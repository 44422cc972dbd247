"""Two small HTTP services over the engine: grounding of mentions, and annotation of texts by a model. For interactive use.

POST a JSON list of objects, get a JSON list back, in the same order. Work of any size belongs into a job.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

#: How many objects and bytes a request may have.
MOST_ROWS, MOST_BYTES = 1000, 10 << 20


def service(answer: Callable[[list[dict]], list[dict]], host: str = "127.0.0.1", port: int = 0) -> ThreadingHTTPServer:
    """A server whose requests go through ``answer``; start it with serve_forever. Port 0 is any free one (server_port)."""

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            try:
                size = int(self.headers.get("Content-Length", 0))
                if size > MOST_BYTES:
                    return self.reply(413, {"error": "request too large"})
                rows = json.loads(self.rfile.read(size))
                if not isinstance(rows, list) or len(rows) > MOST_ROWS or not all(isinstance(r, dict) for r in rows):
                    return self.reply(400, {"error": f"a list of {MOST_ROWS} objects at most is expected"})
                self.reply(200, answer(rows))
            except ValueError as e:
                self.reply(400, {"error": str(e)})

        def reply(self, status: int, body) -> None:
            data = json.dumps(body, ensure_ascii=False).encode()
            self.send_response(status)
            self.send_header("Content-Type", "application/json; charset=utf-8")
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        def log_message(self, *args) -> None:
            pass

    return ThreadingHTTPServer((host, port), Handler)


def grounding_answer(spark, nodes, threshold: float, k: int) -> Callable[[list[dict]], list[dict]]:
    """Objects with a ``vector`` get their ``groundings``. nodes: node, vector."""
    from factloom.operators import ontology

    def answer(rows: list[dict]) -> list[dict]:
        if not all(isinstance(r.get("vector"), list) for r in rows):
            raise ValueError("every object needs a vector")
        if not rows:
            return []
        mentions = spark.createDataFrame([(i, [float(x) for x in r["vector"]]) for i, r in enumerate(rows)], "mention int, vector array<double>")
        got = {r.mention: [g.asDict() for g in r.groundings] for r in ontology.ground_mentions(mentions, nodes, threshold, k).collect()}
        return [r | {"groundings": got[i]} for i, r in enumerate(rows)]

    return answer


def annotation_answer(model: Callable) -> Callable[[list[dict]], list[dict]]:
    """Objects through a model that turns a pandas frame into another (as ``annotators.annotate`` takes it)."""
    import pandas as pd

    return lambda rows: model(pd.DataFrame(rows)).to_dict("records") if rows else []
