"""Reading feeds, reading and writing snapshot tables, and stand-in inputs."""
