"""tapeloom: transcript, interval and vocabulary analytics expressed as Spark plans."""
