"""Video-playback telemetry analytics as ordinary Spark plans."""
