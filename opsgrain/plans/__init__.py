"""End-to-end jobs: inputs to finished tables, each one lazy plan unless noted."""
