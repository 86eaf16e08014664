"""The shared working folder."""

import pytest

from fareloom import session


class Conf:
    def __init__(self, named):
        self.named = named

    def get(self, key, default=None):
        return self.named if key == "spark.checkpoint.dir" and self.named else default


class Session:
    """Just what ``work_root`` asks of a session."""

    def __init__(self, named=None, checkpoint=None):
        self.conf, self.sparkContext, self.checkpoint = Conf(named), self, checkpoint

    def getCheckpointDir(self):  # noqa: N802
        return self.checkpoint


def test_the_named_folder_is_used_and_none_is_made_up():
    assert session.work_root(Session("hdfs://shared/work/")) == "hdfs://shared/work"
    assert session.work_root(Session(checkpoint="/shared")) == "/shared"
    with pytest.raises(RuntimeError, match=r"spark\.checkpoint\.dir"):
        session.work_root(Session())
    a, b = (session.work_path(Session("/shared"), "x") for _ in range(2))
    assert a != b and a.startswith("/shared/fareloom/x-")
