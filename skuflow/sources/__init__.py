"""Sources and sinks: declared schemas, readers/writers, the test-data adapter."""
