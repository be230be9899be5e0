from strata.streaming.scoring import read_stream, score_stream

__all__ = ["read_stream", "score_stream"]
