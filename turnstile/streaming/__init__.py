"""turnstile.streaming"""
