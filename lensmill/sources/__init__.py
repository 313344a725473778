"""Tables, text files and sinks."""
