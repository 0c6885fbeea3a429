"""Sources and sinks: JSON lines, local rows, and the test-table views."""
