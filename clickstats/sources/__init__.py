"""Line and table sources, and the stand-in inputs rendered from the driver tables."""
