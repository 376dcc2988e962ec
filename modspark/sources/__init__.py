"""Sources and sinks: object events, texts, media manifests, detector documents, results."""
