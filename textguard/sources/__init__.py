"""Inputs and outputs: tables, JSON folders, prompt/output pairs, result sinks."""
