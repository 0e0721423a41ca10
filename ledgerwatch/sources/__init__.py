"""Tables, streams, codecs and sinks."""
