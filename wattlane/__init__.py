"""Panel load analytics expressed as Spark DataFrame plans."""

from wattlane.session import build_session, materialize, shared_folder

__all__ = ["build_session", "materialize", "shared_folder"]
