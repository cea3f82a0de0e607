from .incremental import ingest_new_files, reload_days

__all__ = ["ingest_new_files", "reload_days"]
