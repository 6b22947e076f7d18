"""Shared session and review factories."""

from __future__ import annotations

import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from reviewlake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "2",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture
def review():
    def make(rid, text="solid fun", **changes):
        created = changes.pop("created", 1_765_432_100)
        row = {
            "recommendationid": str(rid),
            "author": {
                "steamid": f"player-{rid}",
                "personaname": "nick",
                "profile_url": "https://example.net/nick",
                "avatar": "face.jpg",
                "playtime_at_review": 45,
            },
            "language": "english",
            "review": text,
            "timestamp_created": created,
            "timestamp_updated": changes.pop("updated", created),
            "voted_up": True,
            "votes_up": 0,
            "weighted_vote_score": "0.25",
        }
        row.update(changes)
        return row

    return make


@pytest.fixture
def write_lines():
    def write(root, partition, rows, name="batch_a.jsonl"):
        folder = Path(root) / partition
        folder.mkdir(parents=True, exist_ok=True)
        lines = [r if isinstance(r, str) else json.dumps(r, ensure_ascii=False) for r in rows]
        (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")

    return write
