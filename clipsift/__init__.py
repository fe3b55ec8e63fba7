"""clipsift: content-safety analytics on short-media posts, expressed as Spark plans."""
