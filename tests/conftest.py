import json
import os
import sys

import pytest

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HERE)
os.environ["PYTHONPATH"] = os.pathsep.join([HERE, os.path.join(HERE, "tests"), *filter(None, [os.environ.get("PYTHONPATH")])])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def served():
    """A service on this machine: answers by path, each a JSON value, a status, or a function of the JSON that was sent."""
    import threading
    from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

    answers = {}

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            sent = self.rfile.read(int(self.headers.get("Content-Length") or 0))
            answer = answers.get(self.path, answers.get(self.path.split("?")[0], 404))
            if callable(answer):
                answer = answer(json.loads(sent) if sent else self.path)
            self.send_response(answer if isinstance(answer, int) else 200)
            self.end_headers()
            self.wfile.write(b"" if isinstance(answer, int) else json.dumps(answer).encode())

        do_POST = do_GET

        def log_message(self, *_):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}", answers
    server.shutdown()
