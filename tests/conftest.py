import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pitchside.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cpus=4, shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture
def scratch():
    """A fresh scratch folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="pitchside-test-")


def write_pages(folder: str, pages: dict) -> str:
    """Write {file name: JSON value} as landed pages; returns the folder."""
    os.makedirs(folder, exist_ok=True)
    for name, value in pages.items():
        with open(os.path.join(folder, name), "w") as f:
            json.dump(value, f, indent=1)
    return folder


def fixture(event, h, a, hs, as_, finished=True, **kw):
    row = {"id": kw.pop("id", None), "event": event, "finished": finished,
           "kickoff_time": kw.pop("kickoff_time", "2022-08-05T19:00:00Z"),
           "minutes": 90 if finished else 0, "team_h": h, "team_a": a,
           "team_h_score": hs, "team_a_score": as_, "team_h_difficulty": 2,
           "team_a_difficulty": 3, "stats": kw.pop("stats", [])}
    row.update(kw)
    return row


def team(i, name=None, strength=3):
    return {"id": i, "name": name or f"Team {i}", "strength": strength,
            "strength_overall_home": 1100 + i, "strength_overall_away": 1200 + i,
            "strength_attack_home": 1300 + i, "strength_attack_away": 1400 + i,
            "strength_defence_home": 1500 + i, "strength_defence_away": 1600 + i}
