"""cityflow: road-traffic and accident analytics as Spark DataFrame functions."""
