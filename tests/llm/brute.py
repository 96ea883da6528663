"""Brute-force versions of the operators, one document or pair at a time."""

import hashlib, re, zlib, struct, collections, bisect
W=re.compile(rb"[^\x20\x09-\x0D]+")
LOW=bytes(c+32 if 65<=c<=90 else c for c in range(256))
def op7(docs,L=35):
    ws={i:W.findall((t or "").encode()) for i,t in docs}
    cnt=collections.Counter()
    for i,w in ws.items():
        for s in range(len(w)-L+1): cnt[tuple(w[s:s+L])]+=1
    out={}
    for i,w in ws.items():
        g=[False]*len(w)
        for s in range(len(w)-L+1):
            if cnt[tuple(w[s:s+L])]>1: g[s:s+L]=[True]*L
        kept=b" ".join(x for x,y in zip(w,g) if not y)
        out[i]=(len(w),sum(g),hashlib.sha256(kept).hexdigest())
    return out
def op9(docs,L=100):
    seen=set(); out={}
    for i,t in sorted(docs):
        b=(t or "").encode(); g=[False]*len(b)
        for s in range(len(b)-L+1):
            k=hash(b[s:s+L]) if False else b[s:s+L]
            if k in seen: g[s:s+L]=[True]*L
            else: seen.add(k)
        kept=bytes(x for x,y in zip(b,g) if not y)
        spans=sum(1 for j in range(len(g)) if g[j] and (j==0 or not g[j-1]))
        out[i]=(len(b),sum(g),spans,hashlib.sha256(kept).hexdigest())
    return out
def op1(docs,n=3,pc=85):
    S={}
    for i,t in docs:
        w=W.findall((t or "").encode().translate(LOW))
        S[i]=frozenset(tuple(w[j:j+n]) for j in range(max(1,len(w)-n+1))) if w else frozenset()
    par={i:i for i in S}
    def find(x):
        while par[x]!=x: par[x]=par[par[x]]; x=par[x]
        return x
    inv=collections.defaultdict(list)
    for i,s in S.items():
        for g in s: inv[g].append(i)
    cand=collections.Counter()
    for g,l in inv.items():
        for a in range(len(l)):
            for b in range(a): cand[(l[b],l[a])]+=1
    for (a,b),inter in cand.items():
        if 100*inter>=pc*(len(S[a])+len(S[b])-inter):
            x,y=find(a),find(b); 
            if x!=y: par[max(x,y)]=min(x,y)
    return {i:(len(S[i]),find(i),find(i)==i) for i in S}
def jump(key,n):
    key&=(1<<64)-1; b,j=-1,0
    while j<n:
        b=j; key=(key*2862933555777941757+1)&((1<<64)-1)
        j=int((b+1)*(float(1<<31)/float((key>>33)+1)))
    return b
import math
def op5(docs, K=5):
    L=lambda t: W.findall((t or "").encode().translate(LOW))+[None]
    T={i:L(t) for i,t in docs}; tr=[i for i in T if zlib.crc32(str(i).encode())%5!=1]
    c=collections.Counter(); bg=collections.Counter(); ctx=collections.Counter(); fol=collections.defaultdict(set)
    for i in tr:
        c.update(T[i])
        for h,w in zip(["<s>"]+T[i][:-1],T[i]): bg[h,w]+=1; ctx[h]+=1; fol[h].add(w)
    def gt(cc):
        n=[0]*(K+2)
        for v in cc.values():
            if v<=K+1: n[v]+=1
        last=(K+1)*n[K+1]/n[1] if n[1] else 0
        d=[1]*(K+1)
        for r in range(1,K+1):
            x=((r+1)*n[r+1]/(r*n[r])-last)/(1-last) if n[r] and last<1 else 0
            d[r]=x if 0<x<1 else r/(r+.5)
        return d
    N=sum(c.values()); V=len(c); d1=gt(c); d2=gt(bg)
    pu={w:(d1[v] if v<=K else 1)*v/(N+.5) for w,v in c.items()}; unk=1-sum(pu.values())
    P=lambda w: pu.get(w,unk)
    al={}
    def alpha(h):
        if h not in al:
            s=sum((d2[bg[h,w]] if bg[h,w]<=K else 1)*bg[h,w]/(ctx[h]+.5) for w in fol[h]); al[h]=(1-s)/(1-sum(P(w) for w in fol[h]))
        return al[h]
    out={}
    for i,t in T.items():
        sc=0
        for h,w in zip(["<s>"]+t[:-1],t):
            r=bg.get((h,w),0)
            p=(d2[r] if r<=K else 1)*r/(ctx[h]+.5) if r else (alpha(h) if ctx.get(h) else 1)*P(w)
            sc+=math.log10(p)
        out[i]=(zlib.crc32(str(i).encode())%5==1,len(t),sum(c[w]>0 for w in t),N,sum(math.log10((c[w]+.5)/(N+.5*(V+1))) for w in t),sc)
    return out
def katz(docs, order, K=5):
    """doc id -> score by Katz backoff over n-grams of up to ``order`` words, by recursion."""
    T={i:W.findall((t or "").encode().translate(LOW))+[None] for i,t in docs}
    c=[collections.Counter() for _ in range(order+1)]; ctx=collections.Counter(); fol=collections.defaultdict(set)
    for i in T:
        p=["<s>"]*(order-1)+T[i]
        for j in range(order-1,len(p)) if zlib.crc32(str(i).encode())%5!=1 else ():
            for k in range(1,order+1):
                h=tuple(p[j-k+1:j]); c[k][h+(p[j],)]+=1; ctx[h]+=1; fol[h].add(p[j])
    def gt(cc):
        n=[0]*(K+2)
        for v in cc.values():
            if v<=K+1: n[v]+=1
        last=(K+1)*n[K+1]/n[1] if n[1] else 0
        d=[1]*(K+1)
        for r in range(1,K+1):
            x=((r+1)*n[r+1]/(r*n[r])-last)/(1-last) if n[r] and last<1 else 0
            d[r]=x if 0<x<1 else r/(r+.5)
        return d
    d=[None]+[gt(x) for x in c[1:]]; weight={}
    unknown=1-sum((d[1][v] if v<=K else 1)*v/(ctx[()]+.5) for v in c[1].values())
    def P(h,w):
        r=c[len(h)+1][h+(w,)]
        if r: return (d[len(h)+1][r] if r<=K else 1)*r/(ctx[h]+.5)
        if not h: return unknown
        if ctx[h] and h not in weight: weight[h]=(1-sum(P(h,x) for x in fol[h]))/(1-sum(P(h[1:],x) for x in fol[h]))
        return weight.get(h,1)*P(h[1:],w)
    out={}
    for i,t in T.items():
        p=["<s>"]*(order-1)+t
        out[i]=sum(math.log10(P(tuple(p[j-order+1:j]),p[j])) for j in range(order-1,len(p)))
    return out
