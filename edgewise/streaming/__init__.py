from edgewise.streaming.featurise import featurise_stream, pair_stream  # noqa: F401
