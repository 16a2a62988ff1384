"""News-text analytics as ordinary Spark DataFrame and streaming plans."""

from presswire.session import build_session, scratch_path, shared_dir

__all__ = ["build_session", "scratch_path", "shared_dir"]
