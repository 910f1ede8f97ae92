from .ingest import landing_stream, process_batch, start_ingest

__all__ = ["landing_stream", "process_batch", "start_ingest"]
