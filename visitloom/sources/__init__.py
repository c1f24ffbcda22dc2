"""Tables, files, tasks and sinks."""
