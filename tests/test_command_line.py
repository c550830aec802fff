from __future__ import annotations

import http.server
import json
import os
import struct
import threading
import zlib

import numpy as np
import pytest

from lathework.__main__ import main
from lathework.functions import png
from lathework.operators import collection
from lathework.sources import decoder
from tests.test_contracts import changed, sound


def test_validation(spark, tmp_path, capsys):
    good, bad = tmp_path / "good.json", tmp_path / "bad.json"
    good.write_text(json.dumps(sound()))
    bad.write_text(json.dumps({"split": "train", "samples": [sound(), changed("image.width", 5)]}))
    assert main(["validate-sample", "--path", str(good)]) == 0
    assert main(["validate-manifest", "--path", str(bad)]) == 2 and "image has the target size" in capsys.readouterr().out
    (tmp_path / "list.json").write_text("[]")
    assert main(["validate-sample", "--path", f"{tmp_path}/list.json"]) == 2 and "no JSON object" in capsys.readouterr().err


def test_render_command(tmp_path):
    (tmp_path / "c.png").write_bytes(png.encode(np.full((120, 200, 3), 50, np.uint8)))
    (tmp_path / "c.json").write_text(json.dumps({"text": "ab\ncd", "center": [0.5, 0.7]}))
    assert main(["render", "--clean", f"{tmp_path}/c.png", "--config", f"{tmp_path}/c.json", "--out", f"{tmp_path}/out"]) == 0
    assert png.decode((tmp_path / "out/rendered.png").read_bytes()).shape == (120, 200, 3)
    assert json.loads((tmp_path / "out/metadata.json").read_text())["pairing_ok"]


def test_png_filters():
    """Rows under each of the format's five filters."""
    rng = np.random.default_rng(2)
    image = rng.integers(0, 256, (10, 6, 3)).astype(int)
    wide = np.pad(image, ((1, 0), (1, 0), (0, 0)))
    left, up, corner = wide[1:, :-1], wide[:-1, 1:], wide[:-1, :-1]
    guess = left + up - corner
    near = np.abs(np.stack((guess - left, guess - up, guess - corner))).argmin(0)
    by = [image * 0, left, up, (left + up) // 2, np.choose(near, (left, up, corner))]
    lines = b"".join(bytes([y % 5]) + ((image[y] - by[y % 5][y]) % 256).astype(np.uint8).tobytes() for y in range(10))
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    data = png.MARK + chunk(b"IHDR", struct.pack(">IIBBBBB", 6, 10, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")
    assert (png.decode(data) == image).all()


def test_programs(tmp_path):
    """The decoder's output, from a program that says what it is told to."""
    video, tool = tmp_path / "v.mp4", tmp_path / "tool"
    video.write_bytes(b"v")
    doc = {"format": {"duration": "2.5"}, "streams": [{"codec_type": "audio"}, {"codec_type": "video", "width": 4, "height": 2, "avg_frame_rate": "0/0", "r_frame_rate": "25/1", "time_base": "1/0"}]}
    tool.write_text(f"#!/bin/sh\ncase \"$*\" in *show_streams*) echo '{json.dumps(doc)}';; *missing*) echo gone >&2; exit 3;; *) printf '[x] n: 0 pts: 0 pts_time:0 x\\n n: 1 pts: 40 pts_time:0.04 y\\n' >&2;; esac\n")
    os.chmod(tool, 0o755)
    p = decoder.Programs(str(video), str(tool), str(tool))
    about = p.probe()
    assert (about["duration_seconds"], about["video"]["time_base"], about["video"]["is_vfr"]) == (2.5, {"num": 1, "den": 1000}, True)
    assert decoder.Programs(str(video), str(tool), str(tool))._log("showinfo") == [(0, 0, 0.0), (1, 40, 0.04)] and p.cuts(0.3) == [0.0, 0.04]
    with pytest.raises(OSError, match="gone"):
        decoder.Programs("missing", str(tool), str(tool)).timeline()
    assert decoder.versions(("pyspark", "no-such-package"), ("no-such-program",)) == {"pyspark": decoder.metadata.version("pyspark"), "no-such-package": "", "no-such-program": ""}


class Server(http.server.BaseHTTPRequestHandler):
    data, ranges = bytes(range(256)) * 40, True

    def do_GET(self):  # noqa: N802
        if self.path.endswith("manifest.json"):
            body = json.dumps({"items": [{"item_id": "a", "url": "a.bin"}, {"item_id": "b", "url": "b.bin"}]}).encode()
            self.send_response(200)
        elif (start := self.headers.get("Range")) and self.ranges:
            at = int(start.removeprefix("bytes=").rstrip("-"))
            body = self.data[at:]
            self.send_response(206 if body else 416)
        else:
            body = self.data
            self.send_response(200)
        self.end_headers()
        self.wfile.write(body)

    def log_message(self, *args):
        pass


@pytest.fixture
def url():
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Server)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_downloads_go_on(tmp_path, url, monkeypatch):
    for have, ranges in ((0, True), (1000, True), (1000, False), (len(Server.data), True)):
        monkeypatch.setattr(Server, "ranges", ranges)
        to = tmp_path / f"{have}{ranges}"
        if have:
            to.with_name(to.name + ".part").write_bytes(Server.data[:have])
        assert collection.resume(collection.over_http(f"{url}/a.bin"), to).read_bytes() == Server.data
        assert not to.with_name(to.name + ".part").exists()


def test_collect_and_forget(spark, tmp_path, url, capsys):
    out = f"{tmp_path}/got"
    assert main(["collect", "--source", "s", "--url", url, "--out", out]) == 0
    assert (tmp_path / "got/s/a").read_bytes() == Server.data and spark.read.parquet(f"{out}/ledger").count() == 2
    assert main(["collect", "--source", "s", "--url", url, "--out", out]) == 0 and spark.read.parquet(f"{out}/ledger").count() == 2
    assert main(["forget", "--source", "s", "--item", "a", "--out", out]) == 0
    assert not (tmp_path / "got/s/a").exists() and [r.item_id for r in spark.read.parquet(f"{out}/ledger").collect()] == ["b"]
    assert main(["forget", "--source", "s", "--item", "a", "--out", out]) == 2


def test_registry_commands(spark, tmp_path, capsys):
    rows = [("s", "authorized", True, True, True, None, None), ("t", "unknown", True, True, True, None, None)]
    schema = "source_id string, license_status string, allowed_to_download boolean, allowed_for_derivative_work boolean, allowed_for_ml_training boolean, authorization_start_at date, authorization_expire_at date"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/r")
    assert main(["source-check", "--registry", f"{tmp_path}/r", "--source", "s", "--day", "2024-01-01"]) == 0
    assert main(["source-check", "--registry", f"{tmp_path}/r", "--source", "t", "--day", "2024-01-01"]) == 1
    assert main(["source-rules", "--registry", f"{tmp_path}/r"]) == 2 and "training needs" in capsys.readouterr().out
    spark.createDataFrame([(300,), (400,), (900,)], "duration_ms int").write.parquet(f"{tmp_path}/s")
    (tmp_path / "t.json").write_text(json.dumps({"buckets": [[0, 500, 2], [501, 999, 1]]}))
    assert main(["report", "--samples", f"{tmp_path}/s", "--targets", f"{tmp_path}/t.json"]) == 0 and "within tolerance" in capsys.readouterr().out
