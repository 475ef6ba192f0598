"""strataform: a layered retail warehouse (staging, star schema with SCD2,
marts, data-quality checks) written with the Spark DataFrame API."""

from .session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
