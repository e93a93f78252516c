"""DataFrame-to-DataFrame operators; each works on batch input, most on streams too."""
