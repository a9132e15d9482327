from types import SimpleNamespace

import pytest

from viewlake.session import shared_folder, working_folder


def session(master, folder=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: folder or default),
        sparkContext=SimpleNamespace(master=master),
    )


def test_named_folder_is_used():
    assert shared_folder(session("yarn", "s3a://b/tmp/")) == "s3a://b/tmp"
    first, second = (working_folder(session("yarn", "/shared"), "x") for _ in "ab")
    assert first.startswith("/shared/x-") and first != second


def test_only_a_local_session_may_do_without():
    assert shared_folder(session("local[2]")) == shared_folder(session("local[2]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session("yarn"))
