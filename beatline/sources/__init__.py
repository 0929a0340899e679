"""Readers (connections, captures, labelled flow statistics, truth) and sinks."""
