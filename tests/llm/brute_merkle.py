"""Plain-Python Merkle manifest: the contract of op12 written as loops, for the tests."""
import hashlib, zlib
def H(s): return hashlib.sha256(s.encode()).hexdigest()
def f(v): 
    if v is None: return "-"
    s=str(v); return f"{len(s.encode())}:{s}"
def leaf(r, text=None):
    return H("".join(f(x) for x in (r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"] if text is None else text)))
def tree(digests):
    """levels: list of lists of nodes, bottom-up; returns top and levels"""
    levels=[digests]
    while len(levels[-1])>1:
        cur=levels[-1]; levels.append([H("".join(cur[i:i+16])) for i in range(0,len(cur),16)])
    return levels
def path(levels, i):
    out=[]
    for L in levels[:-1]:
        s=(i//16)*16; run=L[s:s+16]; p=i-s
        out.append(("".join(run[:p]), "".join(run[p+1:]))); i//=16
    return out
def manifest(rows):
    from collections import defaultdict
    by=defaultdict(list)
    for r in rows: by[r["source"]].append(r)
    srcs=sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    subs={}; lv={}; order={}
    for s in srcs:
        rs=sorted(by[s], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        order[s]=rs; lv[s]=tree([leaf(r) for r in rs]); subs[s]=lv[s][-1][0]
    top=tree([subs[s] for s in srcs]); root=top[-1][0]
    out={}
    res=[]
    for si,s in enumerate(srcs):
        sp=path(top, si)
        for i,r in enumerate(order[s]):
            p=path(lv[s], i)+sp
            t=r["text"]
            if r["doc_id"] is not None and t is not None and zlib.crc32(str(r["doc_id"]).encode())%5==0:
                t="".join(chr(ord(c)+32) if "A"<=c<="Z" else c for c in t)
            acc=leaf(r, t if t is not None else None) if t is not None else leaf(r)
            for a,b in p: acc=H(a+acc+b)
            res.append(dict(doc_id=r["doc_id"], leaf=leaf(r), subroot=subs[s], root=root,
                            proof_sha256=H("".join(a+b for a,b in p)), folded_root=acc, verified=acc==root))
    return res
