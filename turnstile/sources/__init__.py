"""turnstile.sources"""
