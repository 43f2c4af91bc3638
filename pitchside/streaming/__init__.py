from .landing import fixture_batch, history_batch, start_fixture_stream, start_history_stream

__all__ = ["fixture_batch", "history_batch", "start_fixture_stream", "start_history_stream"]
